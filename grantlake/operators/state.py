"""Current-state maintenance: newest-wins upserts, keyed deletes, membership changes.

A load is a sequence of groups (``_step``, any sortable type), each of one
operation. Inside a group the removes come before the adds. Applying them one after the other would rewrite
the state once per group; here the whole sequence is one set-oriented plan:

* an upsert is a candidate row, the stored row is the oldest candidate;
* a delete removes the matching candidates of earlier groups (anti join);
* of what is left, the newest candidate of each key wins.

The newest are ranked in each task first, so a hot key sends one row per task; rows of any width move
once, and nothing gathers the rows of a key.

Deletes that spare newer rows leave the same result, as long as all candidates of a key answer to the same
deletes: whatever an older row of the key loses to such a delete, the row that it would have kept out loses, too.
The other keys (a row may change the columns by which it is deleted) are walked in order, see ``_walked``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlake.entities import SCOPE, DeleteRoute, Entity
from grantlake.session import remove_path, scratch_path, stage

TIME = "event_timestamp"


# -- newest per key ----------------------------------------------------------------


def _blank(name: str) -> Column:
    """A key part with "" and NULL made equal; grouping treats NULLs as equal."""
    return F.nullif(F.col(name), F.lit(""))


def _normal(df: DataFrame, keys: list[str]) -> list[Column]:
    """The parts of a key as they are compared; only text has the empty/NULL ambiguity."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return [_blank(k) if k in text else F.col(k) for k in keys]


def key_columns(df: DataFrame, keys: list[str]) -> list[Column]:
    """The parts of a key as grouping expressions ``_k0`` and on."""
    return [k.alias(f"_k{i}") for i, k in enumerate(_normal(df, keys))]


def matches_key(rows: DataFrame, keys: list[str]) -> Column:
    """The condition that joins rows with a frame of ``key_columns``."""
    return reduce(lambda a, b: a & b, [k.eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(_normal(rows, keys))])


def _first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; a task sends one row per key at most."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*_normal(rows, keys)).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def newest_per_key(
    df: DataFrame, keys: list[str], ts: str | None = TIME, order: list[str] | None = None, dated: bool = False
) -> DataFrame:
    """One row per key, as inserting the rows in order and updating only with newer ones would leave.

    Ties keep the earlier row. An undated row is never replaced and never replaces,
    so it wins only where it came first. Without ``ts`` the last arrival wins. ``order`` tells the rows of a key apart; ``dated`` says that all rows have a time.
    """
    order = order or ["_step", "_seq"]
    if ts is None:
        return _first(df, keys, [F.desc(c) for c in order])
    arrival = [F.asc(c) for c in order]
    newest = _first(df, keys, [F.desc_nulls_last(ts), *arrival])
    if dated:
        return newest
    # Keys with an undated row also need to know which row came first; they are few, if any.
    undated = df.filter(F.col(ts).isNull())
    some = df.join(undated.select(*key_columns(df, keys)).distinct(), matches_key(df, keys), "left_semi")
    stuck = _first(some, keys, arrival).filter(F.col(ts).isNull())
    return newest.join(stuck.select(*key_columns(df, keys)), matches_key(newest, keys), "left_anti").unionByName(stuck)


# -- merge -------------------------------------------------------------------------


def as_stored(target: DataFrame, like: DataFrame) -> DataFrame:
    """The stored rows as candidates older than any change: NULL sorts first."""
    return target.withColumns({c: F.lit(None).cast(like.schema[c].dataType) for c in ("_step", "_seq")})


def _before(step: Column, other: Column) -> Column:
    """Whether a candidate precedes a group; the stored row precedes all."""
    return F.coalesce(step < other, F.lit(True))


def merge_latest(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    ts: str | None = TIME,
    order: list[str] | None = None,
    dated: bool = False,
) -> DataFrame:
    """Insert keys not stored, update stored keys where the source row is strictly newer.

    ``order`` names the source's arrival columns (default ``_step``, ``_seq``). They
    settle ties inside the source. All key columns match NULL to NULL.
    """
    columns = target.columns
    order = order or ["_step", "_seq"]
    changes = source.withColumns({"_seq": F.struct(*order), "_step": F.lit(0).cast("long")}).select(
        *columns, "_step", "_seq"
    )
    rows = as_stored(target, changes).unionByName(changes)
    return newest_per_key(rows, keys, ts, dated=dated).select(*columns)


# -- deletes -----------------------------------------------------------------------


def _complete(keys: list[str]) -> Column:
    """Delete keys match by plain equality: an empty or NULL part matches no row."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys])


def _matches(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[f"_d_{k}"] for k in keys])


def apply_deletes(
    target: DataFrame, deletes: DataFrame, keys: list[str], newer_only: bool = False, ts: str = TIME
) -> DataFrame:
    """Drop the rows whose key equals a delete's key, or only those older than it."""
    usable = deletes.filter(_complete(keys))
    grouped = usable.groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys]).agg(F.max(ts).alias("_d_ts"))
    condition = _matches(target, grouped, keys)
    if newer_only:
        condition = condition & (target[ts] < grouped["_d_ts"])
    return target.join(grouped, condition, "left_anti")


def routed(deletes: DataFrame, routes: tuple[DeleteRoute, ...]) -> list[tuple[DeleteRoute, DataFrame]]:
    """Split delete events over the routes; each event takes the first that applies."""
    out, rest = [], F.lit(True)
    for route in routes:
        if route.when_set is None:
            applies = F.lit(True)
        else:
            value = F.col(route.when_set)
            applies = F.coalesce(value != "", F.lit(route.null_is_set))
        out.append((route, deletes.filter(rest & applies)))
        rest = rest & ~applies
    return out


# -- whole loads -------------------------------------------------------------------


def is_removal(entity: Entity) -> Column:
    """Delete events, and membership rows labelled as removals."""
    removal = F.col("_route") == "DELETE"
    if entity.label:
        removal = removal | F.coalesce(F.col(entity.label) == "remove", F.lit(False))
    return removal


def deciding_columns(entity: Entity) -> set[str]:
    """The columns that say which rows a load leaves."""
    return {*entity.state_key, *(c for route in entity.routes for c in (*route.keys, *SCOPE)), TIME} | ({entity.label} if entity.label else set())


def split_changes(changes: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes), with ``_step`` extended so that a group's removes precede its adds."""
    removal = is_removal(entity)

    def phase(number: int) -> Column:
        return F.struct(F.col("_step").alias("group"), F.lit(number).alias("phase"))

    return changes.filter(~removal).withColumn("_step", phase(1)), changes.filter(removal).withColumn("_step", phase(0))


def apply_changes(target: DataFrame, changes: DataFrame, entity: Entity, dated: bool = False, written: bool = False) -> DataFrame:
    """The state after a load.

    ``changes`` are flattened rows with ``_route``, ``_step`` (rank of the group in
    application order) and ``_seq`` (order inside it). ``dated`` says that every row has a time, ``written`` that
    the deletes are written before they meet the rows. The state has the entity's columns that ``target`` has,
    which may leave out those that ``deciding_columns`` does not name.
    """
    columns, keys = [c for c in entity.column_names if c in target.columns], list(entity.state_key)
    upserts, deletes = split_changes(changes, entity)
    rows = as_stored(target.select(*columns), upserts).unionByName(upserts.select(*columns, "_step", "_seq"))
    if not entity.newer_only_delete:
        return newest_per_key(surviving(rows, deletes, entity, written), keys, dated=dated).select(*columns)
    # Written, so their number and size are known before the rows are dealt: none mostly, or few enough to be sent to all tasks.
    path = scratch_path(rows.sparkSession, "knots")
    _knots(rows, entity).write.parquet(path)
    knots = rows.sparkSession.read.schema("_knot long").parquet(path)
    if knots.isEmpty():
        remove_path(rows.sparkSession, path)
        return newest_per_key(surviving(rows, deletes, entity), keys, dated=True).select(*columns)
    hashed = rows.withColumn("_knot", _key_hash(rows, entity))
    alone = surviving(hashed.join(knots, "_knot", "left_anti").drop("_knot"), deletes, entity)
    # Several branches read the rows of these keys.
    tangled = _walked(stage(hashed.join(knots, "_knot", "left_semi").drop("_knot"), "tangled"), deletes, entity)
    return newest_per_key(alone, keys, dated=True).select(*columns).unionByName(tangled.select(*columns))


def _delete_steps(events: DataFrame, keys: list[str], newer_only: bool) -> DataFrame:
    """The groups of each delete key that decide: the last one, or the staircase of times.

    A step of the staircase is a group whose time exceeds those of all later ones; if any later delete is newer than a
    row, then the first step after the row is. The window holds one narrow row per key and group.
    """
    names = [F.col(k).alias(f"_d_{k}") for k in keys]
    usable = events.filter(_complete(keys))
    if not newer_only:
        # All deletes are of one phase; plain numbers are grouped by hash, structs would be sorted.
        last = F.struct(F.max("_step.group").alias("group"), F.max("_step.phase").alias("phase"))
        return usable.groupBy(*names).agg(last.alias("_d_step"))
    groups = usable.filter(F.col(TIME).isNotNull()).groupBy(*names, F.col("_step").alias("_d_step")).agg(F.max(TIME).alias("_d_ts"))
    later = Window.partitionBy(*[f"_d_{k}" for k in keys]).orderBy(F.desc("_d_step")).rowsBetween(Window.unboundedPreceding, -1)
    stairs = groups.withColumn("_later", F.max("_d_ts").over(later))
    return stairs.filter(F.col("_later").isNull() | (F.col("_d_ts") > F.col("_later"))).drop("_later")


def surviving(rows: DataFrame, deletes: DataFrame, entity: Entity, written: bool = False) -> DataFrame:
    """The candidates that no later group deletes.

    ``written`` deletes are counted before the rows are dealt: a route without any takes no part, few are sent to all tasks.
    """
    for route, events in routed(deletes, entity.routes):
        keys = [*route.keys, *SCOPE]
        steps = _delete_steps(events, keys, entity.newer_only_delete)
        if written:
            steps = stage(steps, "deletes")
            if steps.isEmpty():
                continue
        # No part of a delete key is empty; compared as in the state key, rows dealt for the deletes lie right for the newest.
        condition = reduce(lambda a, b: a & b, [k == steps[f"_d_{name}"] for k, name in zip(_normal(rows, keys), keys, strict=True)])
        condition = condition & _before(rows["_step"], steps["_d_step"])
        if entity.newer_only_delete:
            condition = condition & (rows[TIME] < steps["_d_ts"])
        rows = rows.join(steps, condition, "left_anti")
    return rows


# -- keys whose rows answer to different deletes -----------------------------------


def _key_hash(rows: DataFrame, entity: Entity) -> Column:
    return F.xxhash64(*key_columns(rows, list(entity.state_key)))


def _knots(rows: DataFrame, entity: Entity) -> DataFrame:
    """Hashes of the keys with candidates that differ in a column by which they are deleted, or among which one has no time.

    Keys that share a hash by chance are walked as well, which is right for any key.
    """
    loose = sorted({c for route in entity.routes for c in route.keys} - set(entity.state_key))
    mark = F.xxhash64(*loose) if loose else F.lit(0).cast("long")
    narrow = rows.select(_key_hash(rows, entity).alias("_knot"), mark.alias("mark"), F.col(TIME).isNull().alias("undated"))
    found = narrow.groupBy("_knot").agg(F.min("mark").alias("low"), F.max("mark").alias("high"), F.max("undated").alias("undated"))
    return found.filter("low <> high or undated").select("_knot")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each key holds in the end, one event after the other; no more than one row of a key is kept."""
    key = held = None
    for batch in batches:
        done = []
        for k, id, at, kills in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if k != key:
                if held:
                    done.append((key, held[0]))
                key, held = k, None
            if kills:
                if held and held[0] == id:
                    held = None
            elif held is None or (at is not None and held[1] is not None and held[1] < at):
                held = (id, at)
        yield _held(done)
    yield _held([(key, held[0])] if held else [])


def _held(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    columns = ([r[0] for r in rows], [r[1] for r in rows])
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], ["_key", "_id"])


def _walked(rows: DataFrame, deletes: DataFrame, entity: Entity) -> DataFrame:
    """The rows that applying every event in order leaves.

    Each candidate meets at most one delete, the first later one that is newer. Candidates and these deletes are sorted by
    key and group and read once; of the rows of a key only narrow columns are dealt to one task.
    """
    keys = list(entity.state_key)
    key = F.to_json(F.struct(*key_columns(rows, keys)))
    named = rows.withColumns({"_key": key, "_id": F.xxhash64("_step", "_seq")})
    narrow = named.select("_key", "_id", "_step", "_seq", F.unix_micros(F.col(TIME).cast("timestamp")).alias("_at"), TIME,
                          *sorted({c for route in entity.routes for c in (*route.keys, *SCOPE)} - {TIME}))
    kills = None
    for route, events in routed(deletes, entity.routes):
        by = [*route.keys, *SCOPE]
        names = [F.col(k).alias(f"_d_{k}") for k in by]
        groups = events.filter(_complete(by)).groupBy(*names, F.col("_step").alias("_d_step")).agg(F.max(TIME).alias("_d_ts"))
        condition = _matches(narrow, groups, by) & _before(narrow["_step"], groups["_d_step"]) & (narrow[TIME] < groups["_d_ts"])
        hit = narrow.join(groups, condition).select("_key", "_id", "_d_step")
        kills = hit if kills is None else kills.unionByName(hit)
    kills = kills.groupBy("_key", "_id").agg(F.min("_d_step").alias("_step")).withColumn("_kills", F.lit(True))
    events = narrow.select("_key", "_id", "_step", "_seq", "_at", F.lit(False).alias("_kills")).unionByName(kills, allowMissingColumns=True)
    ordered = events.repartition("_key").sortWithinPartitions("_key", "_step", "_seq").select("_key", "_id", "_at", "_kills")
    held = ordered.mapInArrow(_walk, "_key string, _id long")
    return named.join(held, ["_key", "_id"], "left_semi")
