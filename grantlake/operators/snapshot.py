"""Snapshot completion: the batch ledger, the completeness test and stale-row removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_KEY = ["entity_type", "tenancy_id", "service_instance_id", "snapshot_id", "batch_id"]
SNAPSHOT_KEY = LEDGER_KEY[:4]
LEDGER_DDL = ", ".join(f"{k} string" for k in LEDGER_KEY) + ", updated_at timestamp"
PENDING_DDL = ", ".join(f"{k} string" for k in SNAPSHOT_KEY) + ", num_of_batches int, scope_tenancy string, scope_service string"

#: What is read of a load's files.
FILE_COLUMNS = ["message_type", "tenancy_id", "service_instance_id", "snapshot_id", "batch_id", "event_timestamp", "num_of_batches", "is_marker", "_step"]

# Both kinds of rows in one table, so that one publication replaces them together.
TRACKER_DDL = f"{LEDGER_DDL}, num_of_batches int, scope_tenancy string, scope_service string"

NO_SCOPE = "-"


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_DDL)


def empty_pending(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PENDING_DDL)


def split_tracker(tracker: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(registered batches, pending markers); only markers ask for a number of batches."""
    marker = F.col("num_of_batches").isNotNull()
    return (
        tracker.filter(~marker).select(*LEDGER_KEY, "updated_at"),
        tracker.filter(marker).select(*SNAPSHOT_KEY, "num_of_batches", "scope_tenancy", "scope_service"),
    )


def join_tracker(ledger: DataFrame, pending: DataFrame) -> DataFrame:
    columns = [*LEDGER_KEY, "updated_at", "num_of_batches", "scope_tenancy", "scope_service"]
    return ledger.unionByName(pending, allowMissingColumns=True).select(*columns)


def _scope(column: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(NO_SCOPE)).alias(column)


def ledger_rows(files: DataFrame) -> DataFrame:
    """Ledger rows of loaded batch files; a missing scope is written as "-"."""
    return files.select(
        F.col("message_type").alias("entity_type"),
        _scope("tenancy_id"),
        _scope("service_instance_id"),
        "snapshot_id",
        "batch_id",
        F.col("event_timestamp").alias("updated_at"),
        F.col("_step").alias("_at"),
    )


def pending_rows(markers: DataFrame) -> DataFrame:
    """Completion markers, with the scope that limits the removal (NULL: no limit)."""
    return markers.select(
        F.col("message_type").alias("entity_type"),
        _scope("tenancy_id"),
        _scope("service_instance_id"),
        "snapshot_id",
        "num_of_batches",
        F.col("tenancy_id").alias("scope_tenancy"),
        F.col("service_instance_id").alias("scope_service"),
    )


def register_batches(ledger: DataFrame, batches: DataFrame) -> DataFrame:
    """The ledger with the new batches; a batch registered before keeps its first row."""
    stored = ledger.withColumn("_at", F.lit(None).cast(batches.schema["_at"].dataType))
    both = stored.unionByName(batches.select(*ledger.columns, "_at"))
    # The wrapping struct lets the NULL of a stored row sort first.
    return both.groupBy(*LEDGER_KEY).agg(F.min_by("updated_at", F.struct("_at")).alias("updated_at"))


def completed_batches(ledger: DataFrame) -> DataFrame:
    """Batches and earliest batch time of each snapshot."""
    return ledger.groupBy(*SNAPSHOT_KEY).agg(
        F.count("*").alias("n_batches"), F.min("updated_at").alias("cutoff")
    )


def ready_snapshots(ledger: DataFrame, pending: DataFrame) -> DataFrame:
    """Snapshots whose marker asks for no more batches than are registered, with their cutoff."""
    # Markers of one snapshot may differ in what their scope leaves open; each removes what it covers.
    wanted = pending.distinct()
    return (
        wanted.join(completed_batches(ledger), SNAPSHOT_KEY)
        .filter((F.col("n_batches") >= F.col("num_of_batches")) & F.col("cutoff").isNotNull())
    )


def _equal(stored: Column, scope: Column) -> Column:
    # An empty scope limits the removal to nothing, as an empty text equals no text.
    return (stored == scope) & (scope != "")


def remove_stale(state: DataFrame, ready: DataFrame, ts: str = "event_timestamp", load: str | None = None) -> DataFrame:
    """Drop rows older than their snapshot's earliest batch, inside the snapshot's scope.

    ``ready`` holds the snapshots of this entity. Scopes without a tenant or service
    have no equality to join on; that side is one row, the latest such cutoff. ``load`` names a column of both frames: a
    cutoff then only concerns rows of earlier loads.
    """
    for tenancy in (True, False):
        for service in (True, False):
            limited = {"scope_tenancy": tenancy, "scope_service": service}
            mine = ready
            for column, set_ in limited.items():
                mine = mine.filter(F.col(column).isNotNull() if set_ else F.col(column).isNull())
            scope = [c for c, set_ in limited.items() if set_]
            by = [*scope, F.col(load).alias("_load")] if load else scope
            latest = mine.groupBy(*by).agg(F.max("cutoff").alias("_cutoff"))
            condition = state[ts] < latest["_cutoff"]
            if load:
                condition = condition & (state[load] < latest["_load"])
            for column in scope:
                condition = condition & _equal(state[_SCOPED[column]], latest[column])
            state = state.join(latest, condition, "left_anti")
    return state


_SCOPED = {"scope_tenancy": "tenancy_id", "scope_service": "service_instance_id"}


def clear_ledger(ledger: DataFrame, ready: DataFrame) -> DataFrame:
    """The ledger without the finished snapshots, so that a second run finds nothing."""
    return ledger.join(ready.select(*SNAPSHOT_KEY).distinct(), SNAPSHOT_KEY, "left_anti")
