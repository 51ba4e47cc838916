"""State maintenance over the tables: upserts, deletes, membership, whole loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.entities import ENTITIES, SCOPE, DeleteRoute
from grantlake.operators.flatten import flatten
from grantlake.operators.state import apply_changes, apply_deletes, deciding_columns, merge_latest, newest_per_key, routed
from grantlake.plans.registry import OPERATION_SQL, feed, json_of, plain_time, query, spread_table, table, text
from grantlake.session import scratch_path, stage
from grantlake.sinks.tables import StateTable
from grantlake.sources.messages import group_order

_EVENT = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_HALF = "timestamp '2024-01-16 00:00:00'"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query(
    "state_latest",
    """select event_id, ts, user_id, event_type, value, props from (
         select *, row_number() over (partition by user_id order by ts desc, event_id) as rn from events)
       where rn = 1""",
)
def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-1/2: the newest event of each user; the earlier arrival wins a tie."""
    return newest_per_key(_events(spark, sf_dir), ["user_id"], "ts", ["event_id"], dated=True).select(*_EVENT)


@query(
    "state_merge_base",
    f"""with base as (
          select *, 0 as src from (
            select *, row_number() over (partition by user_id order by ts desc, event_id) as rn
            from events where ts < {_HALF}) where rn = 1),
        candidates as (
          select event_id, ts, user_id, event_type, value, props, src from base
          union all
          select event_id, ts, user_id, event_type, value, props, 1 from events where ts >= {_HALF})
        select event_id, ts, user_id, event_type, value, props from (
          select *, row_number() over (partition by user_id order by ts desc, src, event_id) as rn from candidates)
        where rn = 1""",
)
def state_merge_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-1/4: the early half as stored state, the late half merged into it."""
    events = _events(spark, sf_dir).select(*_EVENT)
    base = newest_per_key(events.filter(f"ts < {_HALF}"), ["user_id"], "ts", ["event_id"], dated=True)
    return merge_latest(base, events.filter(f"ts >= {_HALF}"), ["user_id"], "ts", ["event_id"], dated=True)


@query(
    "state_merge_older",
    f"""with base as (
          select *, 0 as src from (
            select *, row_number() over (partition by user_id order by ts desc, event_id) as rn
            from events where ts >= {_HALF}) where rn = 1),
        candidates as (
          select event_id, ts, user_id, event_type, value, props, src from base
          union all
          select event_id, ts, user_id, event_type, value, props, 1 from events where ts < {_HALF})
        select event_id, ts, user_id, event_type, value, props from (
          select *, row_number() over (partition by user_id order by ts desc, src, event_id) as rn from candidates)
        where rn = 1""",
)
def state_merge_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-1: late arrivals; older changes must not overwrite newer state."""
    events = _events(spark, sf_dir).select(*_EVENT)
    base = newest_per_key(events.filter(f"ts >= {_HALF}"), ["user_id"], "ts", ["event_id"], dated=True)
    return merge_latest(base, events.filter(f"ts < {_HALF}"), ["user_id"], "ts", ["event_id"], dated=True)


@query(
    "state_last_arrival",
    """select event_id, ts, user_id, event_type, value, props from (
         select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
       where rn = 1""",
)
def state_last_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-5: without a timestamp the last arrival wins."""
    return newest_per_key(_events(spark, sf_dir), ["user_id"], None, ["event_id"]).select(*_EVENT)


@query(
    "state_undated",
    """with e as (select event_id, user_id, event_type, case when event_type = 'view' then null else ts end as seen_at from events),
            f as (select *, first_value(seen_at) over (partition by user_id order by event_id) as first_at,
                         row_number() over (partition by user_id order by event_id) as arrival,
                         row_number() over (partition by user_id order by seen_at desc nulls last, event_id) as newest from e)
       select event_id, user_id, event_type, seen_at from f
       where case when first_at is null then arrival = 1 else newest = 1 end""",
)
def state_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-1 with missing times: an undated row stays if it came first and never replaces."""
    events = _events(spark, sf_dir).select(
        "event_id", "user_id", "event_type", F.when(F.col("event_type") != "view", F.col("ts")).alias("seen_at")
    )
    return newest_per_key(events, ["user_id"], "seen_at", ["event_id"])


@query(
    "nullsafe_match",
    f"""with e as (select event_id, ts, user_id, nullif(event_type, 'view') as part from events),
             base as (select * from (select *, row_number() over (partition by user_id, part order by ts desc, event_id) as rn
                                     from e where ts < {_HALF}) where rn = 1),
             late as (select * from (select *, row_number() over (partition by user_id, part order by ts desc, event_id) as rn
                                     from e where ts >= {_HALF}) where rn = 1)
        select coalesce(l.event_id, b.event_id) as event_id, coalesce(l.ts, b.ts) as ts,
               coalesce(l.user_id, b.user_id) as user_id, case when l.event_id is null then b.part else l.part end as part
        from base b full join late l on b.user_id = l.user_id and b.part is not distinct from l.part""",
)
def nullsafe_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-3: a key part that is NULL matches NULL."""
    events = _events(spark, sf_dir).select(
        "event_id", "ts", "user_id", F.nullif(F.col("event_type"), F.lit("view")).alias("part")
    )
    base = newest_per_key(events.filter(f"ts < {_HALF}"), ["user_id", "part"], "ts", ["event_id"], dated=True)
    return merge_latest(base, events.filter(f"ts >= {_HALF}"), ["user_id", "part"], "ts", ["event_id"], dated=True)


_PURCHASES = "select event_id, ts, user_id, event_type, value from events where event_type = 'purchase'"


@query(
    "delete_keyed",
    """select o_orderkey, o_custkey, o_orderstatus from orders o
       where not exists (select 1 from events e where e.event_type = 'error' and e.user_id = o.o_custkey)""",
)
def delete_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-1: rows whose key equals a delete event's key go."""
    target = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("user_id"))
    deletes = _events(spark, sf_dir).filter("event_type = 'error'").select("user_id", "ts")
    kept = apply_deletes(target, deletes, ["user_id"], ts="ts")
    return kept.select("o_orderkey", F.col("user_id").alias("o_custkey"), "o_orderstatus")


@query(
    "delete_newer_only",
    f"""select event_id, ts, user_id, event_type, value from ({_PURCHASES}) p
        where not exists (select 1 from events e where e.event_type = 'error' and e.user_id = p.user_id and p.ts < e.ts)""",
)
def delete_newer_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-2: a delete removes only rows older than itself."""
    events = _events(spark, sf_dir)
    target = events.filter("event_type = 'purchase'").select("event_id", "ts", "user_id", "event_type", "value")
    deletes = events.filter("event_type = 'error'").select("user_id", "ts")
    return apply_deletes(target, deletes, ["user_id"], newer_only=True, ts="ts")


_ROUTES = (
    DeleteRoute(("l_orderkey",), when_set="by_order"),
    DeleteRoute(("l_partkey", "l_suppkey"), when_set="by_part"),
    DeleteRoute(("l_suppkey",)),
)


@query(
    "delete_routing",
    """with d as (
         select event_id, ts, user_id as k,
                case when event_type = 'error' then 'y' else '' end as by_order,
                case when event_type = 'view' then 'y' else '' end as by_part
         from events where event_type in ('error', 'view', 'signup'))
       select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate from lineitem l
       where not exists (select 1 from d where by_order <> '' and d.k = l.l_orderkey)
         and not exists (select 1 from d where by_order = '' and by_part <> ''
                         and d.k = l.l_partkey and d.k % 50 = l.l_suppkey)
         and not exists (select 1 from d where by_order = '' and by_part = '' and d.k + 50 = l.l_suppkey)""",
)
def delete_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-3..5: every delete event takes the first key that is set."""
    deletes = _events(spark, sf_dir).filter("event_type in ('error', 'view', 'signup')").select(
        "ts",
        F.when(F.col("event_type") == "error", "y").otherwise("").alias("by_order"),
        F.when(F.col("event_type") == "view", "y").otherwise("").alias("by_part"),
        F.col("user_id").alias("l_orderkey"),
        F.col("user_id").alias("l_partkey"),
        F.when(F.col("event_type") == "view", F.col("user_id") % 50).otherwise(F.col("user_id") + 50).alias("l_suppkey"),
    )
    target = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    for route, events in routed(deletes, _ROUTES):
        target = apply_deletes(target, events, list(route.keys), ts="ts")
    return target


@query(
    "group_order",
    f"""select message_type, operation, row_number() over (partition by message_type order by min(event_id)) as step
        from (select event_id, 'RESOURCE' as message_type, {OPERATION_SQL} as operation from events)
        group by message_type, operation""",
)
def group_order_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GRP-1, SEQ-1: operations in first-seen order."""
    events = _events(spark, sf_dir).select(
        "event_id", F.lit("RESOURCE").alias("message_type"), F.expr(OPERATION_SQL).alias("operation")
    )
    return group_order(events, ["event_id"]).withColumnRenamed("_step", "step")


def resource_changes(spark: SparkSession, sf_dir: str, daily: bool) -> DataFrame:
    """The events table as a feed of resources, one group per day or per operation."""
    events = spread_table(spark, sf_dir, "events").withColumn("_operation", F.expr(OPERATION_SQL))
    if daily:
        events = events.withColumn("_group", F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("long"))
    else:
        steps = group_order(
            events.select("event_id", F.lit("RESOURCE").alias("message_type"), F.col("_operation").alias("operation")),
            ["event_id"],
        )
        events = events.join(
            steps.select(F.col("operation").alias("_operation"), F.col("_step").alias("_group")), "_operation"
        )
    decoded = feed(
        events,
        "RESOURCE",
        json_of(id=text("user_id"), resourceName="event_type", externalId=text("event_id"), customAttributes="props"),
        "ts",
        "event_id",
        operation=F.col("_operation"),
        step=F.col("_group"),
    )
    return flatten(decoded, "RESOURCE")


_STATE_ROW = ["id", "resource_name", "external_id", "operation_type"]


@query(
    "state_daily_load",
    f"""with e as (select *, {OPERATION_SQL} as op, cast(ts as date) as d from events),
             dels as (select user_id, max(d) as last_d from e where op = 'DELETE' group by user_id),
             kept as (select e.*, row_number() over (partition by e.user_id order by ts desc, event_id) as rn
                      from e left join dels using (user_id)
                      where op <> 'DELETE' and (last_d is null or last_d <= d))
        select cast(user_id as varchar) as id, event_type as resource_name, cast(event_id as varchar) as external_id,
               op as operation_type, ts as event_timestamp from kept where rn = 1""",
)
def state_daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS, DEL, SEQ, RTE: a month of daily groups applied in one plan, deletes before adds in each."""
    entity = ENTITIES["RESOURCE"]
    changes = stage(resource_changes(spark, sf_dir, daily=True), "changes")
    state = apply_changes(spark.createDataFrame([], entity.schema), changes, entity, dated=True)
    return state.select(*_STATE_ROW, plain_time("event_timestamp").alias("event_timestamp"))


@query(
    "state_stream_groups",
    f"""with e as (select *, {OPERATION_SQL} as op from events),
             steps as (select op, row_number() over (order by min(event_id)) as step from e group by op),
             s as (select e.*, step from e join steps using (op)),
             dels as (select user_id, max(step) as last_step from s where op = 'DELETE' group by user_id),
             kept as (select s.*, row_number() over (partition by s.user_id order by ts desc, step, event_id) as rn
                      from s left join dels using (user_id)
                      where op <> 'DELETE' and (last_step is null or last_step < step))
        select cast(user_id as varchar) as id, event_type as resource_name, cast(event_id as varchar) as external_id,
               op as operation_type, ts as event_timestamp from kept where rn = 1""",
)
def state_stream_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEQ-1: one message batch, its operations applied in first-seen order."""
    entity = ENTITIES["RESOURCE"]
    changes = stage(resource_changes(spark, sf_dir, daily=False), "changes")
    state = apply_changes(spark.createDataFrame([], entity.schema), changes, entity, dated=True)
    return state.select(*_STATE_ROW, plain_time("event_timestamp").alias("event_timestamp"))


@query(
    "membership_apply",
    """with removed as (select distinct l_orderkey, l_partkey from lineitem where l_returnflag = 'R'),
            added as (select distinct l_orderkey, l_partkey from lineitem where l_returnflag <> 'R'),
            stored as (select distinct l_orderkey, l_partkey from lineitem where l_linenumber <= 3),
            members as (
              select l_orderkey, l_partkey, 'stored' as origin from stored s
              where not exists (select 1 from removed r where r.l_orderkey = s.l_orderkey and r.l_partkey = s.l_partkey)
                and not exists (select 1 from added a where a.l_orderkey = s.l_orderkey and a.l_partkey = s.l_partkey)
              union all
              select l_orderkey, l_partkey, 'change' from added)
       select cast(l_orderkey as varchar) as id, cast(l_partkey as varchar) as member_global_id, origin as name from members
       union all
       select distinct cast(l_orderkey as varchar), '', 'change' from lineitem""",
)
def membership_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MEM-1: stored members, then removes, then adds; every collection keeps its own row."""
    entity = ENTITIES["GLOBAL_IDENTITY_COLLECTION"]
    lines = spread_table(spark, sf_dir, "lineitem").withColumn("_at", F.timestamp_seconds(F.lit(0)).cast("timestamp_ntz"))

    def members(side: str, when) -> DataFrame:
        member = F.struct(F.struct(F.array(F.struct(text("l_partkey").alias("globalIdentityId"))).alias("members")).alias("m"))
        return F.when(when, member["m"]).alias(side)

    def events(df: DataFrame, name: str, ts: str) -> DataFrame:
        removed = F.col("l_returnflag") == "R"
        raw = F.to_json(
            F.struct(
                text("l_orderkey").alias("id"),
                F.lit(name).alias("name"),
                members("add", ~removed if name == "change" else F.lit(True)),
                members("remove", removed if name == "change" else F.lit(False)),
            )
        )
        return feed(df, entity.name, raw, ts, "_seq0", operation=F.lit("UPDATE"))

    ordered = lines.withColumn("_seq0", F.struct("l_orderkey", "l_linenumber", "l_partkey"))
    first = events(ordered.filter("l_linenumber <= 3"), "stored", "_at")
    then = events(ordered.withColumn("_at", F.expr("timestamp_ntz'2000-01-01 00:00:00'")), "change", "_at")
    # Several branches read the changes, so they are written; of columns neither asked for nor deciding, nothing is worked out.
    kept = [c for c in entity.column_names if c in deciding_columns(entity) | {"name"}]

    def changes(df: DataFrame) -> DataFrame:
        return stage(flatten(df, entity.name).select(*kept, "_route", "_step", "_seq"), "changes")

    empty = spark.createDataFrame([], entity.schema).select(*kept)
    base = apply_changes(empty, changes(first), entity, dated=True, written=True)
    state = apply_changes(stage(base, "state"), changes(then), entity, dated=True, written=True)
    return state.select("id", "member_global_id", "name")


def assignment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as assignment changes, one group per day; errors revoke, all else grants."""
    entity = ENTITIES["PERMISSION_ASSIGNMENT"]
    events = spread_table(spark, sf_dir, "events").withColumns(
        {
            "_group": F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("long"),
            # Deletes claim a time a day either side of their own, so some spare the stored row.
            "_at": F.when(
                F.col("event_type") == "error",
                F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")) + ((F.col("event_id") % 3) - 1) * 86400),
            ).otherwise(F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp")))).cast("timestamp_ntz"),
        }
    )
    raw = json_of(
        id=text("user_id"),
        targetIdentityId=F.concat(F.lit("t"), text(F.col("user_id") % 40)),
        permissionId="event_type",
        externalId=text("event_id"),
    )
    decoded = feed(
        events,
        entity.name,
        raw,
        "_at",
        "event_id",
        operation=F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE"),
        step=F.col("_group"),
        version="2.0",
    )
    return flatten(decoded, entity.name)


@query(
    "assignment_fold",
    """with recursive e as (
           select event_id, user_id, event_type, datediff('day', date '2024-01-01', cast(ts as date)) as step,
                  date_trunc('second', ts) + to_days(case when event_type = 'error' then cast(event_id % 3 as integer) - 1 else 0 end) as seen
           from events),
         adds as (select * from (select *, row_number() over (partition by user_id, step order by seen desc, event_id) as rn
                                 from e where event_type <> 'error') where rn = 1),
         dels as (select user_id, step, max(seen) as seen from e where event_type = 'error' group by user_id, step),
         days as (select distinct step from e),
         users as (select distinct user_id from e),
         grid as (select u.user_id, d.step, a.seen as add_at, a.event_id, a.event_type, x.seen as del_at
                  from users u cross join days d
                  left join adds a on a.user_id = u.user_id and a.step = d.step
                  left join dels x on x.user_id = u.user_id and x.step = d.step),
         ranked as (select *, row_number() over (partition by user_id order by step) as n from grid),
         walk as (
           select user_id, cast(0 as bigint) as n, cast(null as timestamp) as seen, cast(null as bigint) as event_id,
                  cast(null as varchar) as event_type from users
           union all
           select w.user_id, r.n,
                  case when r.add_at is not null and (w.seen is null or coalesce(w.seen < r.del_at, false) or w.seen < r.add_at) then r.add_at
                       when coalesce(w.seen < r.del_at, false) then null else w.seen end,
                  case when r.add_at is not null and (w.seen is null or coalesce(w.seen < r.del_at, false) or w.seen < r.add_at) then r.event_id
                       when coalesce(w.seen < r.del_at, false) then null else w.event_id end,
                  case when r.add_at is not null and (w.seen is null or coalesce(w.seen < r.del_at, false) or w.seen < r.add_at) then r.event_type
                       when coalesce(w.seen < r.del_at, false) then null else w.event_type end
           from walk w join ranked r on r.user_id = w.user_id and r.n = w.n + 1)
       select cast(user_id as varchar) as assignment_id, cast(event_id as varchar) as external_id,
              event_type as permission_id, seen as event_timestamp
       from walk where n = (select max(n) from walk) and seen is not null""",
)
def assignment_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-2, DEL-5, MEM-1: a month of grants and revocations that spare newer rows."""
    entity = ENTITIES["PERMISSION_ASSIGNMENT"]
    changes = stage(assignment_changes(spark, sf_dir), "changes")
    state = apply_changes(spark.createDataFrame([], entity.schema), changes, entity, dated=True)
    return state.select(
        "assignment_id", "external_id", "permission_id", plain_time("event_timestamp").alias("event_timestamp")
    )


@query(
    "assignment_routes",
    """with held as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate as seen from lineitem),
            d as (select o_orderkey, o_orderstatus, o_orderdate as seen from orders)
       select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as assignment_id, max(seen) as event_timestamp
       from held h
       where not exists (select 1 from d where o_orderstatus = 'F' and d.o_orderkey = h.l_orderkey and h.seen < d.seen)
         and not exists (select 1 from d where o_orderstatus = 'P' and d.o_orderkey % 500 = h.l_suppkey
                         and d.o_orderkey % 2000 = h.l_partkey and h.seen < d.seen)
       group by 1""",
)
def assignment_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-5: revocations by identity, and by identity and permission, newer rows kept."""
    entity = ENTITIES["PERMISSION_ASSIGNMENT"]
    lines = spread_table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    def rows(df: DataFrame, route: str, step: int, ts: str, **values) -> DataFrame:
        cols = {c.name: F.lit(None if c.kind not in ("text", "json") else "").cast(c.spark_type) for c in entity.columns}
        cols.update({"tenancy_id": F.lit("T"), "service_instance_id": F.lit("S"), "event_timestamp": F.col(ts).cast("timestamp")})
        cols.update(values)
        return df.select(
            *[v.alias(k) for k, v in cols.items()],
            F.lit(route).alias("_route"),
            F.lit(step).cast("long").alias("_step"),
            F.lit(0).alias("_seq"),
        )

    # Each line is held by its order and by its supplier; both are identities here.
    held = rows(lines, "CREATE", 0, "l_shipdate", assignment_id=key, target_identity_id=F.concat(F.lit("o"), text("l_orderkey")))
    orders = spread_table(spark, sf_dir, "orders")
    whole = rows(
        orders.filter("o_orderstatus = 'F'"),
        "DELETE",
        1,
        "o_orderdate",
        target_identity_id=F.concat(F.lit("o"), text("o_orderkey")),
    )
    state = apply_changes(spark.createDataFrame([], entity.schema), held.unionByName(whole), entity)
    by_supplier = stage(state, "state").withColumns(
        {
            "target_identity_id": F.concat(F.lit("s"), F.get(F.split("assignment_id", "-"), F.lit(3))),
            "permission_id": F.get(F.split("assignment_id", "-"), F.lit(2)),
        }
    )
    single = rows(
        orders.filter("o_orderstatus = 'P'"),
        "DELETE",
        2,
        "o_orderdate",
        target_identity_id=F.concat(F.lit("s"), text(F.col("o_orderkey") % 500)),
        permission_id=text(F.col("o_orderkey") % 2000),
    )
    final = apply_changes(by_supplier, single, entity)
    return final.select("assignment_id", plain_time("event_timestamp").alias("event_timestamp"))


# -- delete routes of the entities ---------------------------------------------------


def entity_rows(df: DataFrame, name: str, route: str | Column, step: int, ts: str | Column, **values: Column) -> DataFrame:
    """Change rows of an entity with ``values``, all other columns empty; ``ts`` is the event time."""
    entity = ENTITIES[name]
    columns = {c.name: F.lit("" if c.kind in ("text", "json") else None).cast(c.spark_type) for c in entity.columns}
    time = F.col(ts) if isinstance(ts, str) else ts
    columns |= {"tenancy_id": F.lit("T"), "service_instance_id": F.lit("S"), "event_timestamp": time.cast("timestamp"), **values}
    return df.select(
        *[v.alias(k) for k, v in columns.items()],
        (F.lit(route) if isinstance(route, str) else route).alias("_route"),
        F.lit(step).cast("long").alias("_step"),
        F.monotonically_increasing_id().alias("_seq"),
    )


def _named(prefix: str, column: str | Column) -> Column:
    return F.concat(F.lit(prefix), text(column))


@query(
    "delete_identity",
    """select 'o' || l_orderkey as id, 'p' || l_partkey as ti_id, max(l_shipdate) as event_timestamp from lineitem l
       where not exists (select 1 from orders o where o_orderstatus = 'F' and o.o_orderkey = l.l_orderkey)
         and not exists (select 1 from orders o where o_orderstatus = 'P' and o.o_orderkey = l.l_partkey)
         and not exists (select 1 from orders o where o_orderstatus = 'O' and o.o_custkey * 3 = l.l_partkey)
       group by 1, 2""",
)
def delete_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-4: identities go by their id or, where that is empty or null, by the id of the target."""
    name = "IDENTITY"
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    held = entity_rows(lines, name, "CREATE", 0, "l_shipdate", id=_named("o", "l_orderkey"), ti_id=_named("p", "l_partkey"))
    status = F.col("o_orderstatus")
    deletes = entity_rows(
        orders, name, "DELETE", 1, "o_orderdate",
        id=F.when(status == "F", _named("o", "o_orderkey")).when(status == "P", ""),
        ti_id=F.when(status == "P", _named("p", "o_orderkey")).otherwise(_named("p", F.col("o_custkey") * 3)),
    )
    changes = stage(held.unionByName(deletes), "changes")
    state = apply_changes(spark.createDataFrame([], ENTITIES[name].schema), changes, ENTITIES[name], dated=True)
    return state.select("id", "ti_id", plain_time("event_timestamp").alias("event_timestamp"))


_MEMBERS_SQL = """select 'g' || l_orderkey as id, 'u' || l_partkey as member, max(l_shipdate) as event_timestamp from lineitem l
       where not exists (select 1 from orders o where o_orderstatus = 'F' and o.o_orderkey = l.l_orderkey)
         and not exists (select 1 from orders o where o_orderstatus = 'O' and o.o_orderkey = l.l_orderkey and o.o_custkey = l.l_partkey)
         and not exists (select 1 from lineitem r where r.l_returnflag = 'R' and r.l_orderkey = l.l_orderkey and r.l_partkey = l.l_partkey)
       group by 1, 2"""


def _members(spark: SparkSession, sf_dir: str, name: str, member: str) -> DataFrame:
    """Lines as members of their order's group. Orders delete the whole group (F), nothing (P: the member is null) or one member (O).

    Lines with the flag R are removed by the label of their row. The members come in one load, the deletes and removals in a second one.
    """
    entity = ENTITIES[name]
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    status, own = F.col("o_orderstatus"), {"id": _named("g", "l_orderkey"), member: _named("u", "l_partkey")}
    held = entity_rows(lines, name, "CREATE", 0, "l_shipdate", **own, **{entity.label: F.lit("add")})
    removed = entity_rows(lines.filter("l_returnflag = 'R'"), name, "UPDATE", 1, "l_shipdate", **own, **{entity.label: F.lit("remove")})
    gone = F.when(status == "F", "").when(status == "O", _named("u", "o_custkey"))
    deletes = entity_rows(orders, name, "DELETE", 2, "o_orderdate", id=_named("g", "o_orderkey"), **{member: gone})
    state = StateTable(spark, scratch_path(spark, "members"), entity)
    state.load(stage(held, "changes"))
    state.load(stage(removed.unionByName(deletes), "changes"))
    return state.read().select("id", F.col(member).alias("member"), plain_time("event_timestamp").alias("event_timestamp"))


@query("delete_group", _MEMBERS_SQL)
def delete_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-3: a delete without a member takes the whole group, one with a member that member, one whose member is null nothing."""
    return _members(spark, sf_dir, "CLOUD_GROUP", "identity_global_id")


@query("delete_collection", _MEMBERS_SQL)
def delete_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-3, MEM-1: the same for collections of identities."""
    return _members(spark, sf_dir, "GLOBAL_IDENTITY_COLLECTION", "member_global_id")


@query(
    "delete_every_entity",
    f"""select entity, o_orderpriority as priority, count(*) as n_rows, sum(o_orderkey)::bigint as keys
        from orders, unnest([{", ".join(f"'{name}'" for name in ENTITIES)}]) as e(entity)
        where o_orderstatus <> 'F' or (entity = 'PERMISSION_ASSIGNMENT' and o_orderkey % 2 = 1)
        group by 1, 2""",
)
def delete_every_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DEL-6: every entity's rows are created and deleted by its own key; assignments newer than their delete stay."""
    orders, out = table(spark, sf_dir, "orders"), None
    for name, entity in ENTITIES.items():
        by = {*entity.key, *(c for route in entity.routes for c in route.keys)}
        own = {c: text("o_orderkey") for c in by}
        label = {entity.label: F.lit("")} if entity.label else {}
        held = entity_rows(orders, name, "CREATE", 0, "o_orderdate", **own, **label, event_object_type=F.col("o_orderpriority"))
        day = F.expr("o_orderdate + make_interval(0, 0, 0, if(o_orderkey % 2 = 1, -1, 1))")
        deletes = entity_rows(orders.filter("o_orderstatus = 'F'"), name, "DELETE", 1, day, **own, **label)
        state = apply_changes(spark.createDataFrame([], entity.schema), held.unionByName(deletes), entity, dated=True)
        counts = state.groupBy(F.lit(name).alias("entity"), F.col("event_object_type").alias("priority")).agg(
            F.count("*").alias("n_rows"), F.sum(F.col(entity.key[0]).cast("long")).alias("keys")
        )
        out = counts if out is None else out.unionByName(counts)
    return out
