"""Progress ledger of pulled ranges, as small relational queries.

Structured Streaming keeps its own offsets in the checkpoint; this ledger serves
jobs that pull ranges themselves and reports about them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSETS_DDL = "id long, offset long, end_offset long, application string, start_date timestamp, end_date timestamp"

_STALE_AFTER = "6 hours"


def empty_offsets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OFFSETS_DDL)


def last_offset(offsets: DataFrame, application: str) -> DataFrame:
    """End offset of the application's latest range (no row if it has none)."""
    mine = offsets.filter(F.col("application") == application)
    return mine.orderBy(F.desc("id")).limit(1).select("end_offset")


def last_offsets(offsets: DataFrame) -> DataFrame:
    """End offset of the latest range of every application."""
    return offsets.groupBy("application").agg(F.max_by("end_offset", "id").alias("end_offset"))


def all_unfinished(offsets: DataFrame, now: Column | None = None) -> DataFrame:
    """Ranges of every application opened more than six hours ago and never completed."""
    now = F.current_timestamp() if now is None else now
    stale = F.col("end_date").isNull() & (F.col("start_date") < now - F.expr(f"interval {_STALE_AFTER}"))
    return offsets.filter(stale).select("application", "id", "offset", "end_offset")


def resume_offsets(offsets: DataFrame, now: Column | None = None) -> DataFrame:
    """Where every application with a range goes on: its newest unfinished range's start, else its last end."""
    now = F.current_timestamp() if now is None else now
    stale = F.col("end_date").isNull() & (F.col("start_date") < now - F.expr(f"interval {_STALE_AFTER}"))
    start = F.max_by("offset", F.when(stale, F.col("id")))
    return offsets.groupBy("application").agg(F.coalesce(start, F.max_by("end_offset", "id"), F.lit(0)).cast("long").alias("resume_offset"))


def unfinished_ranges(offsets: DataFrame, application: str, now: Column | None = None) -> DataFrame:
    """Ranges opened more than six hours ago and never completed, newest first."""
    now = F.current_timestamp() if now is None else now
    stale = F.col("end_date").isNull() & (F.col("start_date") < now - F.expr(f"interval {_STALE_AFTER}"))
    mine = offsets.filter((F.col("application") == application) & stale)
    return mine.orderBy(F.desc("id")).select("id", "offset", "end_offset")


def open_range(
    offsets: DataFrame, application: str, start: int, end: int, now: Column | None = None
) -> DataFrame:
    """The ledger with a new open range; ids go on from the highest one."""
    now = F.current_timestamp() if now is None else now
    new = offsets.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id")).select(
        "id",
        F.lit(start).cast("long").alias("offset"),
        F.lit(end).cast("long").alias("end_offset"),
        F.lit(application).alias("application"),
        now.cast("timestamp").alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
    )
    return offsets.unionByName(new)


def complete_range(
    offsets: DataFrame, application: str, start: int, end: int, now: Column | None = None
) -> DataFrame:
    """The ledger with the end date set on every row of that range."""
    now = F.current_timestamp() if now is None else now
    same = (
        (F.col("application") == application) & (F.col("offset") == start) & (F.col("end_offset") == end)
    )
    return offsets.withColumn("end_date", F.when(same, now.cast("timestamp")).otherwise(F.col("end_date")))


def resume_offset(offsets: DataFrame, application: str, now: Column | None = None) -> DataFrame:
    """Where to go on: the newest unfinished range's start, else the last end, else 0."""
    now = F.current_timestamp() if now is None else now
    mine = F.col("application") == application
    stale = mine & F.col("end_date").isNull() & (
        F.col("start_date") < now - F.expr(f"interval {_STALE_AFTER}")
    )
    return offsets.agg(
        F.coalesce(
            F.max_by("offset", F.when(stale, F.col("id"))),
            F.max_by("end_offset", F.when(mine, F.col("id"))),
            F.lit(0).cast("long"),
        ).alias("resume_offset")
    )
