"""Typing of the header block and the filters and labels that depend on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.entities import AUDIT, ENTITIES, OPERATIONS, STATE_TYPES

# The header fields that are read, and the column each one becomes.
HEADER_FIELDS = {
    "messageType": "message_type",
    "operation": "operation",
    "eventTime": "event_time",
    "eventTypeVersion": "event_type_version",
    "correlationId": "correlation_id",
    "status": "status",
    "numOfBatches": "num_of_batches",
    "isDay0": "is_day0",
    "tenancyId": "tenancy_id",
    "serviceInstanceId": "service_instance_id",
}

HEADER_DDL = "struct<" + ", ".join(f"{name}: string" for name in HEADER_FIELDS) + ">"


def tolerant_int(text: Column) -> Column:
    """An integer or numeric text, else NULL."""
    return F.trim(text).try_cast("int")


def tolerant_bool(text: Column) -> Column:
    """True for true and for the text "true" in any case; false for anything else."""
    return F.coalesce(F.lower(F.trim(text)) == "true", F.lit(False))


def event_timestamp(text: Column) -> Column:
    """ISO-8601 with an offset to a UTC instant; digits past the microsecond are cut."""
    return text.try_cast("timestamp")


def typed_header(df: DataFrame, header: str) -> DataFrame:
    """Replace the header struct by its typed columns and the event timestamp."""
    fields = {
        column: F.col(f"{header}.{name}") for name, column in HEADER_FIELDS.items()
    }
    fields["num_of_batches"] = tolerant_int(fields["num_of_batches"])
    fields["is_day0"] = tolerant_bool(fields["is_day0"])
    fields["event_timestamp"] = event_timestamp(fields["event_time"])
    return df.select(*[c for c in df.columns if c != header], *[c.alias(n) for n, c in fields.items()])


def known_type() -> Column:
    """One of the fifteen entity types."""
    return F.col("message_type").isin(*STATE_TYPES)


def audit_type() -> Column:
    return F.col("message_type") == AUDIT.name


def supported_version() -> Column:
    """Version 1.0, plus the further versions an entity declares; a missing version is refused."""
    version = F.col("event_type_version")
    accepted = version == "1.0"
    for entity in ENTITIES.values():
        if entity.versions != ("1.0",):
            mine = F.col("message_type") == entity.name
            accepted = F.when(mine, version.isin(*entity.versions)).otherwise(accepted)
    return F.coalesce(accepted, F.lit(False))


def has_routing_header(df: DataFrame) -> DataFrame:
    """Drop messages without a type or operation."""
    return df.filter(F.col("message_type").isNotNull() & F.col("operation").isNotNull())


#: What a load says of the events it leaves out.
OTHER_JOB = "type of another job"
UNKNOWN_TYPE = "unknown type"
UNKNOWN_OPERATION = "unsupported operation"
UNKNOWN_VERSION = "unsupported version"
NO_HEADER = "no readable header"
SKIPPED = (NO_HEADER, OTHER_JOB, UNKNOWN_TYPE, UNKNOWN_OPERATION, UNKNOWN_VERSION)


def skip_reason(audit: bool = False) -> Column:
    """Why the load cannot handle an event, by its header alone, else NULL."""
    wanted, other = (audit_type(), known_type()) if audit else (known_type(), audit_type())
    operations = ("CREATE",) if audit else OPERATIONS
    operation = F.coalesce(F.col("operation").isin(*operations), F.lit(False))
    return (
        F.when(F.col("message_type").isNull(), NO_HEADER)
        .when(other, OTHER_JOB)
        .when(~F.coalesce(wanted, F.lit(False)), UNKNOWN_TYPE)
        .when(~operation, UNKNOWN_OPERATION)
        .when(~supported_version(), UNKNOWN_VERSION)
    )


def supported_events(df: DataFrame, audit: bool = False) -> DataFrame:
    """Events the load can handle: known type, known operation, supported version."""
    return df.filter(skip_reason(audit).isNull())


def day0_label() -> Column:
    """The operation recorded on the row; routing goes on using the plain operation."""
    operation = F.col("operation")
    return F.when(F.col("is_day0") & (operation == "CREATE"), F.lit("EXPORT")).otherwise(operation)
