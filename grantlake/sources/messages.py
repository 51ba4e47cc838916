"""Stream messages: base64 text around a JSON envelope whose data is JSON text.

Every function takes and returns plain columns, so it works on static and
streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlake.entities import AUDIT, OPERATIONS, STATE_TYPES
from grantlake.sources.headers import HEADER_DDL, has_routing_header, typed_header
from grantlake.sources.payload import explode_payload


def decode_base64(value: Column, layers: int = 2) -> Column:
    """Undo ``layers`` of base64, padded or not; text that is not base64 gives NULL."""
    for _ in range(layers):
        value = F.try_to_binary(value.cast("string"), F.lit("base64"))
    return value.cast("string")


def decode_messages(df: DataFrame, value: str = "value", layers: int = 2) -> DataFrame:
    """Add the typed header columns and ``data``; drop messages without a routing header."""
    return has_routing_header(opened_messages(df, value, layers))


def opened_messages(df: DataFrame, value: str = "value", layers: int = 2) -> DataFrame:
    """Add the typed header columns and ``data``, all empty where a message cannot be read."""
    envelope = F.from_json(decode_base64(F.col(value), layers), f"headers {HEADER_DDL}, data string")
    kept = [c for c in df.columns if c != value]
    opened = df.select(*kept, envelope.alias("_m")).select(
        *kept, F.col("_m.headers").alias("_h"), F.col("_m.data").alias("data")
    )
    return typed_header(opened, "_h")


def group_order(messages: DataFrame, order: list[str]) -> DataFrame:
    """First-seen rank of each operation within its type; at most one row per type and operation."""
    first = messages.groupBy("message_type", "operation").agg(F.min(F.struct(*order)).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("message_type").orderBy("_first"))
    return first.select("message_type", "operation", rank.cast("long").alias("_step"))


def message_events(messages: DataFrame, order: list[str]) -> DataFrame:
    """One row per event of a known type, with ``_step`` from the group order and ``_seq`` from the message order.

    The order of groups counts every decoded message, including those a later
    filter drops, because that is when the groups are first seen.
    """
    # Known types and operations only, so at most a few dozen rows are broadcast; without
    # the hint a stream's unknown size would have Spark shuffle all messages by group.
    known = F.col("message_type").isin(*STATE_TYPES, AUDIT.name) & F.col("operation").isin(*OPERATIONS)
    steps = F.broadcast(group_order(messages.filter(known), order))
    events = explode_payload(messages, "data").withColumns(
        {"_seq": F.struct(*order, "_elem"), "operation_type": F.col("operation")}
    )
    return events.join(steps, ["message_type", "operation"]).drop("_elem")
