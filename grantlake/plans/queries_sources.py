"""Sources, headers and filters, over feeds that Spark renders from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlake.plans.registry import OPERATION_SQL, json_of, plain_time, query, spread_table, table, text
from grantlake.session import scratch_path
from grantlake.sources import files as src_files
from grantlake.sources.headers import (
    event_timestamp,
    known_type,
    supported_events,
    supported_version,
    tolerant_bool,
    tolerant_int,
)
from grantlake.sources.messages import decode_base64, decode_messages, message_events


def _iso(ts: str) -> Column:
    """The time as the feed writes it, with nine digits."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z"))


#: Lines of a feed file, about, where its header leaves a choice.
FILE_LINES = 10_000


#: Feed files with a time of their own that lie in one folder, at most; as many tasks write them, each one file of a folder.
FOLDER_FILES = 128


def _file_numbers(events: DataFrame, lines: int) -> DataFrame:
    """The events with ``file``, which puts neighbouring slots of a day and type together up to about ``lines`` lines.

    The window holds one row per slot, not its events.
    """
    name = ["day", "event_type", "slot"]
    slots = events.groupBy(*[F.col(c).alias(f"_{c}") for c in name]).agg(F.count("*").alias("n"))
    before = Window.partitionBy("_day", "_event_type").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("file", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / lines)).drop("n")
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in name])
    return events.join(slots, match).drop(*[f"_{c}" for c in name])


def write_feed(
    spark: SparkSession, sf_dir: str, only: str = "true", path: str | None = None, key: str = "event_id", value: str = "user_id", time: str | None = None
) -> str:
    """Events as feed files, a header line first in every file.

    A second header line repeats one field, and that later value wins. ``time`` is the time of a file, made of
    ``day``, ``event_type`` and ``slot``; by default its day. A slot is a thousand ids. With ``time`` each slot has a file
    of its own; else the slots of a day and type share files of about ``FILE_LINES`` lines, in their order, so that what
    is listed grows with the lines and not with the slots. Slots with files of their own have folders side by side, which
    one pass lists, ``FOLDER_FILES`` slots of a day and type in a folder.
    """
    events = table(spark, sf_dir, "events").filter(only).withColumns(
        {
            "day": F.date_format("ts", "yyyyMMdd"),
            "slot": F.floor(F.col("event_id") / 1000),
            "_operation": F.expr(OPERATION_SQL),
        }
    )
    events = events.withColumn("file", F.col("slot")) if time else _file_numbers(events, FILE_LINES)
    folders = ["day", "event_type", "file"]
    if time:
        folders = ["folder"]
        block = F.floor(F.col("slot") / FOLDER_FILES)
        place = F.concat_ws("-", *[F.coalesce(text(c), F.lit("none")) for c in ("day", "event_type", block)])
        # Slots of a folder differ in their task, as they differ in what is left over.
        task = F.pmod(F.col("slot") + F.hash("day", "event_type"), F.lit(FOLDER_FILES)).cast("int")
        events = events.withColumns({"folder": place, "task": task})
    header = json_of(
        messageType=F.lit("RESOURCE"),
        operation="_operation",
        eventTime=F.concat(F.date_format(F.to_date("day", "yyyyMMdd"), "yyyy-MM-dd"), F.lit("T00:00:00.123456789Z")) if time is None else _iso(F.expr(time)),
        eventTypeVersion=F.lit("1.0"),
        tenancyId=F.lit("T"),
        serviceInstanceId=F.lit("S"),
        numOfBatches=F.lit(" 30 "),
        isDay0=F.when(F.col("event_type") == "signup", "TRUE").otherwise("no"),
        correlationId=F.lit("first"),
    )
    second = json_of(correlationId=F.concat(F.lit("snap-"), F.col("day")))
    data = json_of(id=text(key), resourceName="event_type", externalId=text(value), customAttributes="props")
    name = ["folder", "task", "day", "event_type", "file"] if time else folders
    files = events.select(*name, *(["slot"] if time else []), "_operation").distinct()

    def header_line(rank: int, fields: Column) -> Column:
        return F.struct(F.lit(rank).alias("rank"), F.lit(-1).cast("long").alias("at"), F.concat(F.lit('{"headers":'), fields, F.lit("}")).alias("value"))

    heads = files.select(*name, F.inline(F.array(header_line(0, header), header_line(1, second))))
    body = events.select(*name, F.lit(2).alias("rank"), F.col("event_id").alias("at"), data.alias("value"))
    lines = heads.unionByName(body)
    path = path or scratch_path(spark, "feed")
    dealt = lines.repartitionById(FOLDER_FILES, "task") if time else lines.repartition(*name)
    ordered = dealt.sortWithinPartitions(*name, "rank", "at").select(*folders, "value")
    # Tasks move their files to their place themselves; nothing reads the folder before all are done.
    ordered.write.partitionBy(*folders).option("mapreduce.fileoutputcommitter.algorithm.version", "2").mode("append").text(path)
    return path


@query(
    "feed_file_scan",
    f"""select cast(event_id as varchar) as id, user_id, {OPERATION_SQL} as operation,
               case when event_type = 'signup' then 'EXPORT' else {OPERATION_SQL} end as operation_type,
               date_trunc('day', ts) + interval 123456 microseconds as event_timestamp, 30 as num_of_batches, event_type = 'signup' as is_day0,
               'snap-' || strftime(ts, '%Y%m%d') as snapshot_id,
               row_number() over (partition by event_type, cast(ts as date), event_id // 1000 order by event_id) as position
        from events""",
)
def feed_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, HDR-1..5, LBL-1/2: feed files read back, headers joined to their lines, line order kept."""
    lines = src_files.read_lines(spark, write_feed(spark, sf_dir), glob="*.txt")
    events = src_files.line_events(lines)
    # Positions count within each thousand ids of a file.
    slot = F.floor(F.get_json_object("raw", "$.id").cast("long") / 1000)
    in_file = F.row_number().over(Window.partitionBy("_file", slot).orderBy("_seq"))
    return events.select(
        F.get_json_object("raw", "$.id").alias("id"),
        F.get_json_object("raw", "$.externalId").cast("long").alias("user_id"),
        "operation",
        "operation_type",
        plain_time("event_timestamp").alias("event_timestamp"),
        "num_of_batches",
        "is_day0",
        "snapshot_id",
        in_file.cast("long").alias("position"),
    )


@query(
    "feed_file_select",
    """select cast(event_id as varchar) as id from events where event_type = 'purchase'""",
)
def feed_file_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6: only the files whose name contains a text."""
    path = write_feed(spark, sf_dir)
    lines = src_files.read_lines(spark, path, glob="*.txt", contains="event_type=purchase")
    return src_files.line_events(lines).select(F.get_json_object("raw", "$.id").alias("id"))


@query(
    "feed_envelope_scan",
    """select cast(o_orderkey as varchar) as id, m as mark, 'RESOURCE' as message_type, o_orderdate as event_timestamp
       from orders, unnest(case o_orderstatus when 'O' then ['single'] when 'F' then ['first', 'second'] else ['text'] end) as u(m)
       where o_orderpriority <> '5-LOW'""",
)
def feed_envelope_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2, GRP-2: one JSON object per file, whose data is an object, a list or text of one."""

    def item(mark: str) -> Column:
        return F.struct(text("o_orderkey").alias("id"), F.lit(mark).alias("mark"))

    header = F.struct(F.lit("RESOURCE").alias("messageType"), F.lit("CREATE").alias("operation"), _iso("o_orderdate").alias("eventTime"))
    status = F.col("o_orderstatus")
    value = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.to_json(F.struct(header.alias("headers"), F.lit(17).alias("data"))))
        .when(status == "O", F.to_json(F.struct(header.alias("headers"), item("single").alias("data"))))
        .when(
            status == "F",
            F.to_json(F.struct(header.alias("headers"), F.array(item("first"), item("second")).alias("data"))),
        )
        .otherwise(F.to_json(F.struct(header.alias("headers"), F.to_json(item("text")).alias("data"))))
    )
    whole_files = spread_table(spark, sf_dir, "orders").select(
        value.alias("value"),
        F.concat(F.lit("file:/feed/"), text("o_orderkey"), F.lit(".json")).alias("_file"),
        F.col("o_orderdate").cast("timestamp").alias("_modified"),
    )
    return src_files.envelope_events(whole_files).select(
        F.get_json_object("raw", "$.id").alias("id"),
        F.get_json_object("raw", "$.mark").alias("mark"),
        "message_type",
        plain_time("event_timestamp").alias("event_timestamp"),
    )


@query(
    "file_ids",
    """select o_orderkey, 'batch-' || o_custkey as batch_id,
              case when o_orderstatus = 'O' then 'corr-' || o_custkey else '/feed/' || o_orderpriority || '/batch-' || o_custkey || '.jsonl' end as snapshot_id
       from orders""",
)
def file_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LBL-2: batch and snapshot ids from file names and headers."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("/feed/"), "o_orderpriority", F.lit("/batch-"), text("o_custkey"), F.lit(".jsonl")).alias("_file"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("corr-"), text("o_custkey")))
        .when(F.col("o_orderstatus") == "F", "")
        .alias("correlation_id"),
        F.col("o_orderdate").alias("_modified"),
    )
    return src_files.with_file_ids(orders).select("o_orderkey", "batch_id", "snapshot_id")


def message_frame(spark: SparkSession, sf_dir: str, only: str = "true", unrouted: str = "event_type = 'view'") -> DataFrame:
    """Events as stream messages: JSON text in an envelope in two layers of base64, some unpadded."""
    header = F.struct(
        F.lit("RESOURCE").alias("messageType"),
        F.when(~F.expr(unrouted), F.expr(OPERATION_SQL)).alias("operation"),
        _iso("ts").alias("eventTime"),
        F.lit("1.0").alias("eventTypeVersion"),
        F.lit("T").alias("tenancyId"),
        F.lit("S").alias("serviceInstanceId"),
    )
    payload = json_of(id=text("user_id"), externalId=text("event_id"), resourceName="event_type", customAttributes="props")
    listed = F.when(F.col("event_type") == "click", F.concat(F.lit("["), payload, F.lit(","), payload, F.lit("]"))).otherwise(payload)
    message = F.to_json(F.struct(header.alias("headers"), listed.alias("data")))
    once = F.base64(message.cast("binary"))
    twice = F.base64(once.cast("binary"))
    events = spread_table(spark, sf_dir, "events").filter(only)
    return events.select("event_id", F.when(F.col("event_id") % 2 == 0, F.rtrim(twice, F.lit("="))).otherwise(twice).alias("value"))


@query(
    "message_decode",
    f"""with s as (select {OPERATION_SQL} as operation, min(event_id) as first from events where event_type <> 'view' group by 1),
             r as (select operation, row_number() over (order by first) as step from s)
        select cast(event_id as varchar) as external_id, cast(user_id as varchar) as id, e.operation, step, ts as event_timestamp
        from (select *, {OPERATION_SQL} as operation from events where event_type <> 'view') e join r using (operation),
             unnest(case when event_type = 'click' then [1, 2] else [1] end) as u(n)""",
)
def message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3, SRC-5, FLT-4, GRP-1/2: messages without an operation go, lists come apart, groups are ranked."""
    events = message_events(decode_messages(message_frame(spark, sf_dir)), ["event_id"])
    return events.select(
        F.get_json_object("raw", "$.externalId").alias("external_id"),
        F.get_json_object("raw", "$.id").alias("id"),
        "operation",
        F.col("_step").alias("step"),
        plain_time("event_timestamp").alias("event_timestamp"),
    )


@query("base64_decode", "select event_id, props as once, props as twice, cast(null as varchar) as broken from events")
def base64_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3..5: one and two layers, with and without padding."""
    once = F.rtrim(F.base64(F.col("props").cast("binary")), F.lit("="))
    twice = F.base64(F.base64(F.col("props").cast("binary")).cast("binary"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        decode_base64(once, 1).alias("once"),
        decode_base64(twice, 2).alias("twice"),
        decode_base64(F.concat(F.lit("~"), F.col("props")), 1).alias("broken"),
    )


@query(
    "header_values",
    """select o_orderkey,
              case when o_orderkey % 4 < 2 then cast(o_custkey as varchar) end as num_of_batches,
              o_orderkey % 3 = 0 as is_day0
       from orders""",
)
def header_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HDR-2, HDR-3: numbers and flags in the forms feeds use."""
    number = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit(" "), text("o_custkey"), F.lit(" ")))
        .when(F.col("o_orderkey") % 4 == 1, text("o_custkey"))
        .when(F.col("o_orderkey") % 4 == 2, F.concat(text("o_custkey"), F.lit(".5")))
    )
    flag = F.when(F.col("o_orderkey") % 3 == 0, F.lit(" True ")).when(F.col("o_orderkey") % 3 == 1, "yes")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text(tolerant_int(number)).alias("num_of_batches"), tolerant_bool(flag).alias("is_day0")
    )


@query(
    "time_normalise",
    """select event_id, ts as utc, ts - interval 150 minutes as shifted, cast(null as timestamp) as unreadable from events""",
)
def time_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HDR-4: offsets applied, nanoseconds cut."""
    local = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("999+02:30"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        plain_time(event_timestamp(_iso("ts"))).alias("utc"),
        plain_time(event_timestamp(local)).alias("shifted"),
        plain_time(event_timestamp(F.concat(F.lit("t"), text("event_id")))).alias("unreadable"),
    )


_TYPE_SQL = "case event_type when 'signup' then 'PERMISSION_ASSIGNMENT' when 'view' then 'ROLE' when 'error' then 'AUDIT_EVENTS' when 'click' then 'RESOURCE' else 'WIDGET' end"
_VERSION_SQL = "case when event_id % 4 = 0 then '2.0' when event_id % 4 = 1 then null else '1.0' end"


@query(
    "type_version_filter",
    f"""select event_id, message_type, event_type_version from (
          select event_id, {_TYPE_SQL} as message_type, {_VERSION_SQL} as event_type_version from events)
        where message_type in ('PERMISSION_ASSIGNMENT', 'ROLE', 'RESOURCE')
          and (event_type_version = '1.0' or (message_type = 'PERMISSION_ASSIGNMENT' and event_type_version = '2.0'))""",
)
def type_version_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1, FLT-3: known types in supported versions."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.expr(_TYPE_SQL).alias("message_type"), F.expr(_VERSION_SQL).alias("event_type_version")
    )
    return events.filter(known_type() & supported_version())


@query(
    "audit_filter",
    f"""select event_id from (select event_id, event_type, {_TYPE_SQL} as message_type, {_VERSION_SQL} as v from events)
        where message_type = 'AUDIT_EVENTS' and v = '1.0'""",
)
def audit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2: the audit job takes audit events only."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(_TYPE_SQL).alias("message_type"),
        F.expr(_VERSION_SQL).alias("event_type_version"),
        F.lit("CREATE").alias("operation"),
    )
    return supported_events(events, audit=True).select("event_id")


@query(
    "completion_markers",
    """with per_day as (select cast(o_orderdate as date) as d, count(*) filter (where o_orderstatus <> 'P') as n from orders group by 1)
       select strftime(d, '%Y-%m-%d') as batch_id, 12 as num_of_batches from per_day where n = 0""",
)
def completion_markers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-5: files without data, with a batch number and status COMPLETED; a day is a file here."""
    orders = table(spark, sf_dir, "orders").withColumn("_file", F.date_format("o_orderdate", "yyyy-MM-dd"))
    files = orders.select("_file").distinct().select(
        "_file",
        F.col("_file").alias("batch_id"),
        tolerant_int(F.lit(" 12")).alias("num_of_batches"),
        F.lit(" completed ").alias("status"),
    )
    data = orders.filter("o_orderstatus <> 'P'")
    return src_files.completion_markers(files, data).select("batch_id", "num_of_batches")
