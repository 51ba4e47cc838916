"""Snapshots, progress, rejects, tables and jobs over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.entities import AUDIT, ENTITIES
from grantlake.operators import offsets as off
from grantlake.operators import rejects as rej
from grantlake.operators import snapshot as snap
from grantlake.operators.flatten import flatten
from grantlake.plans.jobs import run
from grantlake.plans.load import LoadReport, finish_snapshots, load_history, load_state
from grantlake.plans.queries_sources import message_frame, write_feed
from grantlake.plans.queries_state import resource_changes
from grantlake.plans.registry import OPERATION_SQL, feed, json_of, plain_time, query, spread_table, table, text
from grantlake.session import scratch_path
from grantlake.sinks.tables import HistoryTable, RejectTable, StateTable
from grantlake.streaming.feeds import FeedConfig, audit_stream, stream_to_history, stream_to_state

# -- snapshots ---------------------------------------------------------------------

# A month of one priority's orders is a batch, a year is a snapshot; odd years miss a batch.
_SNAPSHOT_SQL = """
  batches as (select o_orderpriority as tenancy_id, year(o_orderdate) as y, month(o_orderdate) as m,
                     min_by(o_orderdate, o_orderkey) as updated_at from orders group by 1, 2, 3),
  done as (select tenancy_id, cast(y as varchar) as snapshot_id, y, count(*) as n_batches, min(updated_at) as cutoff from batches group by 1, 2, 3),
  ready as (select * from done where n_batches >= case when y % 2 = 0 then 12 else 13 end)"""


def _order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("ROLE").alias("message_type"),
        F.col("o_orderpriority").alias("tenancy_id"),
        F.lit(None).cast("string").alias("service_instance_id"),
        F.year("o_orderdate").cast("string").alias("snapshot_id"),
        F.month("o_orderdate").cast("string").alias("batch_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
        F.col("o_orderkey").alias("_step"),
    )


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.register_batches(snap.empty_ledger(spark), snap.ledger_rows(_order_files(spark, sf_dir)))


def _markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _order_files(spark, sf_dir).select(
        "message_type", "tenancy_id", "service_instance_id", "snapshot_id"
    ).distinct()
    wanted = F.when(F.col("snapshot_id").cast("int") % 2 == 0, 12).otherwise(13)
    return snap.pending_rows(files.withColumn("num_of_batches", wanted))


@query(
    "snapshot_ledger",
    """select 'ROLE' as entity_type, o_orderpriority as tenancy_id, '-' as service_instance_id,
              cast(year(o_orderdate) as varchar) as snapshot_id, cast(month(o_orderdate) as varchar) as batch_id,
              min_by(o_orderdate, o_orderkey) as updated_at
       from orders group by 2, 4, 5""",
)
def snapshot_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNP-1: one ledger row per batch; repeated registrations keep the first."""
    ledger = _ledger(spark, sf_dir)
    return ledger.select(*snap.LEDGER_KEY, plain_time("updated_at").alias("updated_at"))


@query(
    "snapshot_complete",
    f"with {_SNAPSHOT_SQL} select tenancy_id, snapshot_id, n_batches, cutoff from ready",
)
def snapshot_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNP-2..4: batch counts, the completeness test, the earliest batch time."""
    ready = snap.ready_snapshots(_ledger(spark, sf_dir), _markers(spark, sf_dir))
    return ready.select("tenancy_id", "snapshot_id", "n_batches", plain_time("cutoff").alias("cutoff"))


@query(
    "snapshot_ledger_cleared",
    f"""with {_SNAPSHOT_SQL}
        select b.tenancy_id, cast(y as varchar) as snapshot_id, cast(m as varchar) as batch_id from batches b
        where not exists (select 1 from ready r where r.tenancy_id = b.tenancy_id and r.y = b.y)""",
)
def snapshot_ledger_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNP-6: finished snapshots leave the ledger."""
    ledger = _ledger(spark, sf_dir)
    ready = snap.ready_snapshots(ledger, _markers(spark, sf_dir))
    return snap.clear_ledger(ledger, ready).select("tenancy_id", "snapshot_id", "batch_id")


@query(
    "stale_rows",
    """with cutoffs as (
         select event_type as tenancy_id, case when event_type = 'click' then 'odd' end as service, median(epoch_us(ts)) as cutoff
         from events where event_type in ('view', 'click') group by 1
         union all select null, 'never', max(epoch_us(ts)) + 1 from events)
       select event_id, user_id, event_type, ts from events e
       where not exists (select 1 from cutoffs c where epoch_us(e.ts) < c.cutoff
           and (c.tenancy_id is null or c.tenancy_id = e.event_type)
           and (c.service is null or c.service = case when e.user_id % 2 = 1 then 'odd' else 'even' end))""",
)
def stale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNP-5: rows older than the cutoff go, within the tenant and service where these are set."""
    events = table(spark, sf_dir, "events")
    state = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("event_type").alias("tenancy_id"),
        F.when(F.col("user_id") % 2 == 1, "odd").otherwise("even").alias("service_instance_id"),
    )
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    scoped = events.filter("event_type in ('view', 'click')").groupBy("event_type").agg(
        F.timestamp_micros(F.ceil(F.median(micros))).alias("cutoff")
    ).select(
        F.col("event_type").alias("scope_tenancy"),
        F.when(F.col("event_type") == "click", "odd").alias("scope_service"),
        "cutoff",
    )
    other = events.agg(F.timestamp_micros(F.max(micros) + 1).alias("cutoff")).select(
        F.lit(None).cast("string").alias("scope_tenancy"), F.lit("never").alias("scope_service"), "cutoff"
    )
    kept = snap.remove_stale(state, scoped.unionByName(other))
    return kept.select("event_id", "user_id", "event_type", plain_time("event_timestamp").alias("ts"))


@query(
    "stale_rows_open_scopes",
    """select event_id, user_id, ts from events
       where not (ts < timestamp '2024-01-04 00:00:00' or (user_id % 3 = 1 and ts < timestamp '2024-01-15 00:00:00')
                  or (event_type = 'view' and ts < timestamp '2024-01-10 00:00:00')
                  or (event_type = 'click' and user_id % 3 = 2 and ts < timestamp '2024-01-20 00:00:00'))""",
)
def stale_rows_open_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNP-5: cutoffs without any scope, of a service of all tenants, of a tenant with all services, and of both."""
    state = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("event_type").alias("tenancy_id"), F.concat(F.lit("s"), F.col("user_id") % 3).alias("service_instance_id"),
    )
    cutoffs = [(None, None, 4), (None, "s1", 15), (None, "s1", 2), ("view", None, 10), ("click", "s2", 20), ("", "s0", 30)]
    ready = spark.createDataFrame(cutoffs, "scope_tenancy string, scope_service string, day int")
    ready = ready.withColumn("cutoff", F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)))
    return snap.remove_stale(state, ready).select("event_id", "user_id", plain_time("event_timestamp").alias("ts"))


# -- progress ----------------------------------------------------------------------

_NOW = "timestamp '2001-01-01 03:00:00'"


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as processed ranges of the applications named by their priority."""
    start = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("offset"),
        (F.col("o_custkey") + 10).alias("end_offset"),
        F.col("o_orderpriority").alias("application"),
        start.alias("start_date"),
        F.when(F.col("o_orderstatus") != "O", start).alias("end_date"),
    )


def _now() -> Column:
    return F.expr(_NOW).cast("timestamp")


@query(
    "offset_last",
    "select o_custkey + 10 as end_offset from orders where o_orderpriority = '2-HIGH' order by o_orderkey desc limit 1",
)
def offset_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OFS-1."""
    return off.last_offset(_ranges(spark, sf_dir), "2-HIGH")


@query(
    "offset_unfinished",
    f"""select o_orderkey as id, o_custkey as "offset", o_custkey + 10 as end_offset from orders
        where o_orderpriority = '1-URGENT' and o_orderstatus = 'O' and o_orderdate < {_NOW} - interval 6 hours""",
)
def offset_unfinished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OFS-2."""
    return off.unfinished_ranges(_ranges(spark, sf_dir), "1-URGENT", _now())


@query(
    "offset_complete",
    """select o_orderkey as id, case when o_orderpriority = '3-MEDIUM' and o_custkey = 25 then timestamp '2001-01-01 03:00:00'
              when o_orderstatus <> 'O' then o_orderdate end as end_date from orders""",
)
def offset_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OFS-3: completing a range sets its end."""
    done = off.complete_range(_ranges(spark, sf_dir), "3-MEDIUM", 25, 35, _now())
    return done.select("id", plain_time("end_date").alias("end_date"))


@query(
    "offset_resume",
    f"""select application, coalesce(
          (select o_custkey from orders o where o.o_orderpriority = a.application and o_orderstatus = 'O'
             and o_orderdate < {_NOW} - interval 6 hours order by o_orderkey desc limit 1),
          (select o_custkey + 10 from orders o where o.o_orderpriority = a.application order by o_orderkey desc limit 1), 0) as resume_offset
        from (select unnest(['1-URGENT', '5-LOW', 'unseen']) as application) a""",
)
def offset_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OFS-4: unfinished start, else last end, else zero."""
    ranges = _ranges(spark, sf_dir)
    parts = [
        off.resume_offset(ranges, name, _now()).select(F.lit(name).alias("application"), "resume_offset")
        for name in ("1-URGENT", "5-LOW", "unseen")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "offset_last_all",
    "select o_orderpriority as application, max_by(o_custkey + 10, o_orderkey) as end_offset from orders group by 1",
)
def offset_last_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OFS-1, of every application."""
    return off.last_offsets(_ranges(spark, sf_dir))


@query(
    "offset_unfinished_all",
    f"""select o_orderpriority as application, o_orderkey as id, o_custkey as "offset", o_custkey + 10 as end_offset from orders
        where o_orderstatus = 'O' and o_orderdate < {_NOW} - interval 6 hours""",
)
def offset_unfinished_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OFS-2, of every application."""
    return off.all_unfinished(_ranges(spark, sf_dir), _now())


@query(
    "offset_resume_all",
    f"""select o_orderpriority as application, coalesce(
          max_by(o_custkey, o_orderkey) filter (o_orderstatus = 'O' and o_orderdate < {_NOW} - interval 6 hours),
          max_by(o_custkey + 10, o_orderkey)) as resume_offset from orders group by 1""",
)
def offset_resume_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OFS-4, of every application."""
    return off.resume_offsets(_ranges(spark, sf_dir), _now())


# -- rejects -----------------------------------------------------------------------


def _document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as workflow events: the text must fit its column, some versions are no number."""
    documents = spread_table(spark, sf_dir, "documents").withColumn("_at", F.expr("timestamp_ntz'2020-01-01 00:00:00'"))
    raw = json_of(
        id=text("doc_id"),
        name="source",
        description="text",
        version=F.when(F.col("n_chars") % 5 == 0, F.concat(F.lit("v"), text("n_chars"))).otherwise(text("n_chars")),
    )
    return flatten(feed(documents, "APPROVAL_WORKFLOW", raw, "_at", "doc_id"), "APPROVAL_WORKFLOW")


_REASON_SQL = """case when strlen(text) > 4000 then 'value too large for column description (maximum 4000)'
                      when n_chars % 5 = 0 then 'invalid number in column version' end"""


@query("rejects_split", f"select cast(doc_id as varchar) as id, {_REASON_SQL} as reason from documents")
def rejects_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: every row with the reason it cannot be loaded, if any."""
    checked = rej.with_reason(_document_rows(spark, sf_dir), ENTITIES["APPROVAL_WORKFLOW"])
    return checked.select("id", F.col("_reason").alias("reason"))


@query(
    "rejects_valid",
    f"select cast(doc_id as varchar) as id, text as description, n_chars as version from documents where ({_REASON_SQL}) is null",
)
def rejects_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: the rows that load."""
    checked = rej.with_reason(_document_rows(spark, sf_dir), ENTITIES["APPROVAL_WORKFLOW"])
    return rej.valid_rows(checked).select("id", "description", "version")


@query(
    "rejects_top5",
    f"""select lang || '/' || source || ': ' || ({_REASON_SQL}) as reason, count(*) as n_rows from documents
        where ({_REASON_SQL}) is not null group by 1 order by n_rows desc, reason limit 5""",
)
def rejects_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: the five most frequent reasons, told apart by language and source."""
    checked = rej.rejected_rows(rej.with_reason(_document_rows(spark, sf_dir), ENTITIES["APPROVAL_WORKFLOW"]))
    origin = table(spark, sf_dir, "documents").select(text("doc_id").alias("id"), "lang", "source")
    named = checked.join(origin, "id").withColumn(
        "_reason", F.concat("lang", F.lit("/"), "source", F.lit(": "), "_reason")
    )
    return rej.top_reasons(named)


# -- tables and jobs ---------------------------------------------------------------


@query(
    "history_append",
    f"""select cast(user_id as varchar) as id, cast(event_id as varchar) as external_id, {OPERATION_SQL} as operation_type, ts as event_timestamp
        from events, unnest([1, 2]) as u(copy)""",
)
def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: two loads append, duplicates kept; a replayed load adds nothing."""
    rows = resource_changes(spark, sf_dir, daily=True)
    history = HistoryTable(spark, scratch_path(spark, "history"), ENTITIES["RESOURCE"])
    for load in ("first", "second", "second"):
        history.append(rows, load)
    return history.read().select("id", "external_id", "operation_type", plain_time("event_timestamp").alias("event_timestamp"))


@query(
    "state_table_loads",
    f"""with e as (select *, {OPERATION_SQL} as op, cast(ts as date) as d from events),
             dels as (select user_id, max(d) as last_d from e where op = 'DELETE' group by user_id),
             kept as (select e.*, row_number() over (partition by e.user_id order by ts desc, event_id) as rn
                      from e left join dels using (user_id)
                      where op <> 'DELETE' and (last_d is null or last_d <= d))
        select cast(user_id as varchar) as id, event_type as resource_name, cast(event_id as varchar) as external_id,
               ts as event_timestamp from kept where rn = 1""",
)
def state_table_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4, RTE-1: the state table loaded in three parts, one of them replayed."""
    rows = resource_changes(spark, sf_dir, daily=True)
    state = StateTable(spark, scratch_path(spark, "state"), ENTITIES["RESOURCE"])
    state.create()
    for batch, (low, high) in enumerate([(0, 10), (10, 20), (20, 1000)]):
        part = rows.filter(F.col("_step").between(low, high - 1))
        state.load(part, "daily", batch)
        state.load(part, "daily", batch)
    return state.read().select("id", "resource_name", "external_id", plain_time("event_timestamp").alias("event_timestamp"))


@query(
    "state_reads_by_tenant",
    f"""with e as (select *, {OPERATION_SQL} as op, cast(ts as date) as d from events),
             dels as (select user_id, max(d) as last_d from e where op = 'DELETE' group by user_id),
             kept as (select e.*, row_number() over (partition by e.user_id order by ts desc, event_id) as rn
                      from e left join dels using (user_id)
                      where op <> 'DELETE' and (last_d is null or last_d <= d))
        select 't' || (user_id % 7) as tenancy_id, cast(user_id as varchar) as id, cast(event_id as varchar) as external_id,
               ts as event_timestamp from kept where rn = 1""",
)
def state_reads_by_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: seven tenants' rows, read one tenant after the other from a table that is compacted between two of three loads."""
    rows = resource_changes(spark, sf_dir, daily=True).withColumn("tenancy_id", F.concat(F.lit("t"), F.col("id").cast("long") % 7))
    state = StateTable(spark, scratch_path(spark, "state"), ENTITIES["RESOURCE"], part_rows=1000)
    for batch, (low, high) in enumerate([(0, 10), (10, 20), (20, 1000)]):
        state.load(rows.filter(F.col("_step").between(low, high - 1)), "daily", batch)
        if batch == 1:
            state.compact()
    parts = [state.read(tenancy_id=f"t{k}") for k in range(7)]
    found = reduce(DataFrame.unionByName, parts)
    return found.select("tenancy_id", "id", "external_id", plain_time("event_timestamp").alias("event_timestamp"))


def _message_files(spark: SparkSession, messages: DataFrame) -> str:
    # One message per line; Spark's base64 breaks long text into lines of its own.
    path = scratch_path(spark, "messages")
    messages.select(F.translate("value", "\r\n", "").alias("value")).write.text(path)
    return path


def _feed_config(spark: SparkSession, path: str, name: str, max_files: int = 2, **more) -> FeedConfig:
    return FeedConfig(
        path, scratch_path(spark, name), scratch_path(spark, f"{name}-progress"), max_files=max_files, **more
    )


@query(
    "file_to_state",
    f"""select cast(event_id as varchar) as id, event_type as resource_name, cast(user_id as varchar) as external_id,
               case when event_type = 'signup' then 'EXPORT' else {OPERATION_SQL} end as operation_type,
               date_trunc('day', ts) + interval 123456 microseconds as event_timestamp
        from events where event_type <> 'error'""",
)
def file_to_state_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-1, JOB-6, SRC-7: feed files picked up as they arrive, into the state table."""
    config = _feed_config(spark, write_feed(spark, sf_dir), "file-state", max_files=400, glob="*.txt")
    run(spark, "file", config).awaitTermination()
    state = StateTable(spark, config.root, ENTITIES["RESOURCE"]).read()
    return state.select(
        "id", "resource_name", "external_id", "operation_type", plain_time("event_timestamp").alias("event_timestamp")
    )


@query(
    "file_to_history",
    f"""select cast(event_id as varchar) as id, cast(user_id as varchar) as external_id,
               case when event_type = 'signup' then 'EXPORT' else {OPERATION_SQL} end as operation_type,
               date_trunc('day', ts) + interval 123456 microseconds as event_timestamp
        from events""",
)
def file_to_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-2: feed files into the history table."""
    config = _feed_config(spark, write_feed(spark, sf_dir), "file-history", max_files=400, glob="*.txt")
    run(spark, "file_to_ts", config).awaitTermination()
    rows = HistoryTable(spark, config.root, ENTITIES["RESOURCE"]).read()
    return rows.select("id", "external_id", "operation_type", plain_time("event_timestamp").alias("event_timestamp"))


@query(
    "snapshot_finalize",
    f"""with e as (select *, {OPERATION_SQL} as op, cast(ts as date) as d from events),
             dels as (select user_id, max(d) as last_d from e where op = 'DELETE' group by user_id),
             kept as (select e.*, row_number() over (partition by e.user_id order by ts desc, event_id) as rn
                      from e left join dels using (user_id)
                      where op <> 'DELETE' and (last_d is null or last_d <= d))
        select cast(user_id as varchar) as id, cast(event_id as varchar) as external_id, ts as event_timestamp from kept
        where rn = 1 and ts >= (select min(d) from e where d >= date '2024-01-25')""",
)
def snapshot_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNP-7: with all batches registered and the marker seen, rows the snapshot did not bring go, once."""
    root = scratch_path(spark, "snapshot")
    state = StateTable(spark, root, ENTITIES["RESOURCE"])
    state.load(resource_changes(spark, sf_dir, daily=True))
    # Every day from the 25th on is a batch of one snapshot.
    day = F.to_date("ts")
    batches = table(spark, sf_dir, "events").filter(day >= F.lit("2024-01-25").cast("date")).select(
        day.cast("timestamp").alias("event_timestamp"), day.cast("string").alias("batch_id")
    ).distinct()
    marker = batches.agg(
        F.max("event_timestamp").alias("event_timestamp"), F.lit("end").alias("batch_id"), F.count("*").cast("int").alias("num_of_batches")
    )
    files = batches.withColumns({"num_of_batches": F.lit(None).cast("int"), "is_marker": F.lit(False)}).unionByName(
        marker.withColumn("is_marker", F.lit(True))
    )
    header = {
        "message_type": "RESOURCE",
        "operation": "CREATE",
        "event_type_version": "1.0",
        "tenancy_id": "T",
        "service_instance_id": "S",
        "snapshot_id": "january",
    }
    files = files.withColumns({k: F.lit(v) for k, v in header.items()}).withColumn("_step", F.col("event_timestamp"))
    finish_snapshots(spark, files.filter("not is_marker"), root, "files", 0)
    finish_snapshots(spark, files.filter("is_marker"), root, "files", 1)
    return state.read().select("id", "external_id", plain_time("event_timestamp").alias("event_timestamp"))


@query(
    "stream_to_state",
    """select cast(user_id as varchar) as id, cast(event_id as varchar) as external_id, event_type as resource_name, ts as event_timestamp from (
         select *, row_number() over (partition by user_id order by ts desc, event_id) as rn from events where event_type not in ('view', 'error'))
       where rn = 1""",
)
def stream_to_state_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-3, SRC-8: messages read as a stream in small batches leave the same state as one batch."""
    messages = message_frame(spark, sf_dir, "event_type <> 'error'")
    config = _feed_config(spark, _message_files(spark, messages), "stream-state")
    stream_to_state(spark, config).awaitTermination()
    state = StateTable(spark, config.root, ENTITIES["RESOURCE"]).read()
    return state.select("id", "external_id", "resource_name", plain_time("event_timestamp").alias("event_timestamp"))


# Events come in three parts, the last of one day, so that some users' last event is a delete and others' is not.
_PART_SQL = "case when ts < timestamp '2024-01-16 00:00:00' then 0 when ts < timestamp '2024-01-30 00:00:00' then 1 else 2 end"
_PARTS = 3

# Files of one day have different times, so the newest row does not hang on the order in which files were written.
_FILE_RANK_SQL = "case event_type when 'signup' then 0 when 'view' then 1 when 'click' then 2 when 'purchase' then 3 else 4 end"
_FILE_TIME = f"timestampadd(MICROSECOND, slot * 8 + {_FILE_RANK_SQL}, to_timestamp(day, 'yyyyMMdd'))"


@query(
    "file_to_state_all",
    f"""with e as (select *, {_PART_SQL} as part, {OPERATION_SQL} as op,
                      date_trunc('day', ts) + to_microseconds(event_id // 1000 * 8 + {_FILE_RANK_SQL}) as file_time from events),
             dels as (select user_id, max(part) as last_part from e where op = 'DELETE' group by user_id),
             kept as (select e.*, row_number() over (partition by user_id order by file_time desc, event_id) as rn
                      from e left join dels using (user_id) where op <> 'DELETE' and (last_part is null or last_part < part))
        select cast(user_id as varchar) as id, event_type as resource_name, cast(event_id as varchar) as external_id,
               case when event_type = 'signup' then 'EXPORT' else op end as operation_type, file_time as event_timestamp
        from kept where rn = 1""",
)
def file_to_state_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-1: files that arrive in parts, each part's deletes last, insert, update and delete the users' rows."""
    config = _feed_config(spark, scratch_path(spark, "feed"), "file-state", max_files=400, glob="*.txt")
    for part in range(_PARTS):
        for kind in ("<>", "="):
            only = f"{_PART_SQL} = {part} and event_type {kind} 'error'"
            write_feed(spark, sf_dir, only, config.path, key="user_id", value="event_id", time=_FILE_TIME)
            run(spark, "file", config).awaitTermination()
    state = StateTable(spark, config.root, ENTITIES["RESOURCE"]).read()
    return state.select(
        "id", "resource_name", "external_id", "operation_type", plain_time("event_timestamp").alias("event_timestamp")
    )


@query(
    "stream_to_state_all",
    f"""with e as (select *, {_PART_SQL} as part, {OPERATION_SQL} as op from events),
             steps as (select part, op, min(event_id) as step from e group by 1, 2),
             s as (select e.*, row(part, step) as seen from e join steps using (part, op)),
             dels as (select user_id, max(seen) as last_seen from s where op = 'DELETE' group by user_id),
             kept as (select s.*, row_number() over (partition by user_id order by ts desc, seen, event_id) as rn
                      from s left join dels using (user_id) where op <> 'DELETE' and (last_seen is null or last_seen < seen))
        select cast(user_id as varchar) as id, cast(event_id as varchar) as external_id, event_type as resource_name,
               op as operation_type, ts as event_timestamp from kept where rn = 1""",
)
def stream_to_state_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-3: all messages, deletes too, in one batch a part; in a batch, operations apply in the order first seen."""
    messages = message_frame(spark, sf_dir, unrouted="false").join(
        table(spark, sf_dir, "events").select("event_id", F.expr(_PART_SQL).alias("part")), "event_id"
    )
    config = _feed_config(spark, scratch_path(spark, "messages"), "stream-state")
    for part in range(_PARTS):
        messages.filter(F.col("part") == part).select("event_id", "value").write.mode("append").parquet(config.path)
        stream = spark.readStream.schema("event_id long, value string").parquet(config.path)
        stream_to_state(spark, config, stream, ["event_id"]).awaitTermination()
    state = StateTable(spark, config.root, ENTITIES["RESOURCE"]).read()
    return state.select(
        "id", "external_id", "resource_name", "operation_type", plain_time("event_timestamp").alias("event_timestamp")
    )


@query(
    "stream_to_history",
    f"""select cast(user_id as varchar) as id, cast(event_id as varchar) as external_id, {OPERATION_SQL} as operation_type, ts as event_timestamp
        from events, unnest(case when event_type = 'click' then [1, 2] else [1] end) as u(copy) where event_type <> 'view'""",
)
def stream_to_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-4: messages read as a stream into the history table."""
    config = _feed_config(spark, _message_files(spark, message_frame(spark, sf_dir)), "stream-history")
    stream_to_history(spark, config).awaitTermination()
    rows = HistoryTable(spark, config.root, ENTITIES["RESOURCE"]).read()
    return rows.select("id", "external_id", "operation_type", plain_time("event_timestamp").alias("event_timestamp"))


@query(
    "stream_audit",
    """select conv_id as conversation, turn as request_time, case when role = 'user' then '["***"]' else text end as value from conversations""",
)
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-5, SNK-2: audit messages masked and appended."""
    turns = spread_table(spark, sf_dir, "conversations")
    payload = F.struct(
        F.when(F.col("role") == "user", "userCredentials").otherwise("note").alias("selection"), F.col("text").alias("value")
    )
    data = json_of(
        source=text("conv_id"), request=F.struct(F.col("turn").alias("requestTime"), payload.alias("payload"))
    )
    header = F.struct(
        F.lit("AUDIT_EVENTS").alias("messageType"),
        F.lit("CREATE").alias("operation"),
        F.lit("2025-01-01T00:00:00Z").alias("eventTime"),
        F.lit("1.0").alias("eventTypeVersion"),
    )
    once = F.base64(F.to_json(F.struct(header.alias("headers"), data.alias("data"))).cast("binary"))
    messages = turns.select(F.base64(once.cast("binary")).alias("value"))
    config = _feed_config(spark, _message_files(spark, messages), "audit")
    audit_stream(spark, config).awaitTermination()
    rows = HistoryTable(spark, config.root, AUDIT).read()
    return rows.select(
        F.col("source").cast("long").alias("conversation"),
        "request_time",
        F.get_json_object("request_payload", "$.value").alias("value"),
    )


@query(
    "load_report",
    f"""select 'RESOURCE' as entity, 'state' as target, count(*) as n_events, count(*) as n_rows from events
        union all select 'RESOURCE', 'history', count(*), count(*) from events""",
)
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-1/2, OBS-1: counts of events and rows that each load reports."""
    events = spread_table(spark, sf_dir, "events")
    decoded = feed(
        events,
        "RESOURCE",
        json_of(id=text("user_id"), externalId=text("event_id")),
        "ts",
        "event_id",
        operation=F.expr(OPERATION_SQL),
        step=F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("long"),
    )
    root = scratch_path(spark, "report")
    state = load_state(spark, decoded, root, "report", 0)
    history = load_history(spark, decoded, root, "report-0")
    rows = [
        ("RESOURCE", target, report.events["RESOURCE"], report.rows["RESOURCE"])
        for target, report in (("state", state), ("history", history))
    ]
    return spark.createDataFrame(rows, "entity string, target string, n_events long, n_rows long")


# Every kind of input a load leaves out: types, operations and versions it does not know, numbers with a fraction.
_REFUSED_SQL = """case event_type when 'view' then 'unknown type' when 'error' then 'unsupported operation'
                  when 'click' then 'unsupported version'
                  else case when event_id % 2 = 1 then 'invalid number in column created_on' end end"""


def _mixed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    number = F.when(F.col("event_id") % 2 == 1, F.concat(text("event_id"), F.lit(".5"))).otherwise(text("event_id"))
    decoded = feed(
        events.withColumn("_number", number), "ROLE", F.struct("event_type", json_of(id=text("event_id"), createdOn="_number").alias("text")),
        "ts", "event_id",
    )
    kind = F.col("raw.event_type")
    return decoded.withColumns({
        "message_type": F.when(kind == "view", "NOBODY").otherwise(F.col("message_type")),
        "operation": F.when(kind == "error", "MOVE").otherwise(F.col("operation")),
        "event_type_version": F.when(kind == "click", "9.0").otherwise(F.col("event_type_version")),
        "raw": F.col("raw.text"),
    })


@query(
    "load_account",
    f"""select coalesce({_REFUSED_SQL}, 'loaded') as outcome, count(*) as n_events, (select count(*) from events) as n_input
        from events group by 1""",
)
def load_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OBS-1, SNK-3: each event is loaded, rejected or skipped; the report's counts add up to the input."""
    report = load_history(spark, _mixed_events(spark, sf_dir), scratch_path(spark, "account"), "account")
    refused = [(reason, n) for entity in report.reasons.values() for reason, n in entity]
    counts = [*report.skipped.items(), *refused, ("loaded", sum(report.rows.values()))]
    total = spark.createDataFrame(counts, "outcome string, n_events long")
    return total.withColumn("n_input", F.lit(table(spark, sf_dir, "events").count()))


@query(
    "messages_account",
    """select case event_type when 'view' then 'no readable header' else 'loaded' end as outcome,
              sum(case event_type when 'click' then 2 else 1 end)::bigint as n_events from events group by 1""",
)
def messages_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OBS-1, FLT-4: messages that cannot be decoded are counted and kept, so a stream's counts add up to what it read."""
    kinds = table(spark, sf_dir, "events").select("event_id", "event_type")
    broken = F.when(F.col("event_type") == "view", F.concat(F.lit("!"), F.substring("value", 1, 40))).otherwise(F.col("value"))
    messages = message_frame(spark, sf_dir, unrouted="false").join(kinds, "event_id").select("event_id", broken.alias("value"))
    reports: list[LoadReport] = []
    config = _feed_config(spark, scratch_path(spark, "messages"), "account", on_report=reports.append)
    messages.write.parquet(config.path)
    stream = spark.readStream.schema("event_id long, value string").parquet(config.path)
    stream_to_history(spark, config, stream, ["event_id"]).awaitTermination()
    kept = RejectTable(spark, config.root).read().groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n_events"))
    loaded = [("loaded", sum(n for report in reports for n in report.rows.values()))]
    return kept.unionByName(spark.createDataFrame(loaded, "outcome string, n_events long"))


@query(
    "rejects_kept",
    f"""select case when event_type = 'view' then 'NOBODY' else 'ROLE' end as entity, {_REFUSED_SQL} as reason,
               cast(event_id as varchar) as id from events where ({_REFUSED_SQL}) is not null""",
)
def rejects_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: rejected rows and skipped events stay readable with their reason, once after a replay too."""
    events, root = _mixed_events(spark, sf_dir), scratch_path(spark, "rejects")
    for _ in range(2):
        load_history(spark, events, root, "same")
    return RejectTable(spark, root).read().select("entity", "reason", F.get_json_object("content", "$.id").alias("id"))


@query(
    "history_undated",
    """select cast(event_id as varchar) as id, case when event_type <> 'view' then ts end as event_timestamp from events""",
)
def history_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: history keeps rows without an event time."""
    undated = table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_type") != "view", F.col("ts")))
    root = scratch_path(spark, "undated")
    load_history(spark, feed(undated, "ROLE", json_of(id=text("event_id")), "ts", "event_id"), root, "undated")
    return HistoryTable(spark, root, ENTITIES["ROLE"]).read().select("id", plain_time("event_timestamp").alias("event_timestamp"))
