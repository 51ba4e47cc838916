import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlake.entities import ENTITIES
from grantlake.plans import queries_state
from grantlake.plans.queries_state import entity_rows
from grantlake.operators.state import apply_changes, apply_deletes, deciding_columns, merge_latest, newest_per_key
from grantlake.session import stage
from grantlake.sinks.tables import StateTable
from tests import fold

DAY = dt.datetime(2025, 1, 1)


def at(n):
    return None if n is None else DAY + dt.timedelta(minutes=n)


def change_schema(entity):
    return T.StructType(
        [
            *entity.schema.fields,
            T.StructField("_route", T.StringType()),
            T.StructField("_step", T.LongType()),
            T.StructField("_seq", T.LongType()),
        ]
    )


def default_row(entity, **values):
    row = {c.name: "" if c.kind == "text" else "{}" if c.kind == "json" else None for c in entity.columns}
    return {**row, "tenancy_id": "T", "service_instance_id": "S", **values}


def as_set(rows, columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in rows)


KEY_POOLS = {
    "ROLE": {"id": ["a", "b"], "access_bundle_id": ["", "x", "y"]},
    "IDENTITY": {"id": ["a", "b", "", None], "ti_id": ["", "x", "y", None]},
    "CLOUD_GROUP": {
        "id": ["a", "b"],
        "identity_global_id": ["", "x", "y", None],
        "identity_target_identity_id": ["", "t"],
        "target_id": ["", "z"],
        "identity_operation_type": ["add", "remove", ""],
    },
    "GLOBAL_IDENTITY_COLLECTION": {
        "id": ["a", "b"],
        "member_global_id": ["", "x", "y"],
        "member_operation_type": ["add", "remove", ""],
    },
    "CLOUD_POLICY": {"id": ["a", "b"], "policy_statement_id": ["p", "q", ""], "subject_id": ["", "s"]},
    "PERMISSION_ASSIGNMENT": {
        "assignment_id": ["a", "b", "c", ""],
        "target_identity_id": ["i", "j"],
        "permission_id": ["", "p", "q"],
        "identity_operation_type": ["add", "remove", ""],
    },
}


def random_changes(rng, entity, n, steps):
    routes = {s: rng.choice(["CREATE", "UPDATE", "DELETE"]) for s in range(steps)}
    out = []
    for seq in range(n):
        values = {k: rng.choice(v) for k, v in KEY_POOLS[entity.name].items()}
        step = rng.randrange(steps)
        if entity.name == "PERMISSION_ASSIGNMENT" and routes[step] != "DELETE":
            values["assignment_id"] = rng.choice(["a", "b", "c"])
        row = default_row(
            entity,
            **values,
            event_timestamp=at(rng.choice([None, *range(6), *range(6)])),
            attributes=f'{{"n":{seq}}}',
            tenancy_id=rng.choice(["T", "T", "U"]),
        ) if "attributes" in entity.column_names else default_row(
            entity, **values, event_timestamp=at(rng.choice([None, *range(6)])), username=str(seq)
        )
        out.append({**row, "_route": routes[step], "_step": step, "_seq": seq})
    return out


@pytest.mark.parametrize("name", sorted(KEY_POOLS))
def test_whole_load_equals_sequential_fold(spark, name):
    entity = ENTITIES[name]
    columns = entity.column_names
    schema = change_schema(entity)
    # Many independent runs in one frame: the tenant keeps them apart.
    changes, base_rows, expected = [], [], []
    for run in range(60):
        rng = random.Random(run)
        base_state = fold.apply({}, [
            {**c, "_route": "CREATE", "_step": 0, **({entity.label: "add"} if entity.label else {})}
            for c in random_changes(rng, entity, 5, 1)
            if name != "PERMISSION_ASSIGNMENT" or c["assignment_id"]
        ], entity)
        mine = random_changes(rng, entity, rng.randrange(1, 16), rng.randrange(1, 6))
        tag = lambda r: {**r, "tenancy_id": f'{r["tenancy_id"]}{run}'}  # noqa: B023,E731
        base = [tag(r) for r in base_state.values()]
        mine = [tag(r) for r in mine]
        base_rows += [{c: r[c] for c in columns} for r in base]
        changes += mine
        start = {tuple(r[k] or None for k in entity.state_key): r for r in base}
        expected += fold.apply(start, mine, entity).values()
    target = spark.createDataFrame([tuple(r[c] for c in columns) for r in base_rows], entity.schema)
    frame = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in changes], schema)
    got = apply_changes(target, frame, entity).collect()
    assert as_set(got, columns) == as_set(expected, columns)


@pytest.mark.parametrize("name", sorted(KEY_POOLS))
def test_loads_and_compactions_equal_sequential_fold(spark, tmp_path, name):
    """Several loads with compactions between them, resolved by the reader."""
    entity = ENTITIES[name]
    schema = change_schema(entity)
    loads, expected = [[], [], [], []], []
    for run in range(40):
        rng = random.Random(1000 + run)
        state = {}
        for part in loads:
            mine = [{**r, "tenancy_id": f'{r["tenancy_id"]}{run}'} for r in random_changes(rng, entity, rng.randrange(1, 9), rng.randrange(1, 4))]
            mine = [{**r, "event_timestamp": r["event_timestamp"] or at(rng.randrange(6))} for r in mine]
            part += mine
            fold.apply(state, mine, entity)
        expected += state.values()
    table = StateTable(spark, str(tmp_path), entity, part_rows=20)
    for number, part in enumerate(loads):
        frame = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in part], schema)
        table.load(frame, "feed", number)
        if number == 1:
            table.compact()
    assert as_set(table.read().collect(), entity.column_names) == as_set(expected, entity.column_names)
    table.compact()
    assert as_set(table.read().collect(), entity.column_names) == as_set(expected, entity.column_names)


def test_struct_steps_order_like_numbers(spark):
    entity = ENTITIES["ROLE"]
    schema = change_schema(entity)
    rows = [
        {**default_row(entity, id="a", event_timestamp=at(1)), "_route": "CREATE", "_step": 1, "_seq": 0},
        {**default_row(entity, id="a"), "_route": "DELETE", "_step": 2, "_seq": 1},
        {**default_row(entity, id="b"), "_route": "DELETE", "_step": 1, "_seq": 2},
        {**default_row(entity, id="b", event_timestamp=at(0)), "_route": "CREATE", "_step": 2, "_seq": 3},
    ]
    frame = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
    frame = frame.withColumn("_step", F.struct(F.lit(DAY).alias("at"), F.col("_step").cast("string").alias("file")))
    empty = spark.createDataFrame([], entity.schema)
    assert [r["id"] for r in apply_changes(empty, frame, entity).collect()] == ["b"]


def test_ties_keep_the_stored_row_and_later_wins_without_time(spark):
    target = spark.createDataFrame([("k", 5, "old")], "key string, at int, v string").withColumn(
        "event_timestamp", F.timestamp_seconds("at")
    )
    source = spark.createDataFrame(
        [("k", 5, "tie", 1), ("n", 1, "first", 2), ("n", 3, "newest", 3), ("n", 3, "tie", 4)],
        "key string, at int, v string, pos int",
    ).withColumn("event_timestamp", F.timestamp_seconds("at"))
    merged = merge_latest(target, source, ["key"], order=["pos"])
    assert sorted((r["key"], r["v"]) for r in merged.collect()) == [("k", "old"), ("n", "newest")]
    untimed = merge_latest(target, source, ["key"], ts=None, order=["pos"])
    assert sorted((r["key"], r["v"]) for r in untimed.collect()) == [("k", "tie"), ("n", "tie")]


def test_keys_treat_empty_and_null_alike(spark):
    rows = spark.createDataFrame(
        [("a", "", 1, 1), ("a", None, 2, 2), (None, "x", 1, 3), ("", "x", 5, 4)], "k1 string, k2 string, t int, _seq int"
    ).withColumns({"event_timestamp": F.timestamp_seconds("t"), "_step": F.lit(0)})
    got = newest_per_key(rows, ["k1", "k2"])
    assert sorted(r["t"] for r in got.collect()) == [2, 5]


def test_delete_with_empty_key_matches_nothing(spark):
    target = spark.createDataFrame([("", 1), ("a", 1)], "id string, t int").withColumn(
        "event_timestamp", F.timestamp_seconds("t")
    )
    deletes = spark.createDataFrame([("", 9), (None, 9), ("a", 1)], "id string, t int").withColumn(
        "event_timestamp", F.timestamp_seconds("t")
    )
    assert {r["id"] for r in apply_deletes(target, deletes, ["id"]).collect()} == {""}
    assert apply_deletes(target, deletes, ["id"], newer_only=True).count() == 2


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 1).alias("k"), F.timestamp_seconds("id").alias("event_timestamp"), F.lit(0).alias("_step"), F.col("id").alias("_seq")
    )
    plan = newest_per_key(rows, ["k"], dated=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_plans_gather_no_rows_of_a_key(spark):
    entity = ENTITIES["PERMISSION_ASSIGNMENT"]
    changes = spark.createDataFrame([], change_schema(entity))
    plan = apply_changes(spark.createDataFrame([], entity.schema), changes, entity)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan and "struct(target_identity_id" not in plan


def test_keys_without_tangled_rows_are_neither_looked_up_nor_walked(spark):
    name = "PERMISSION_ASSIGNMENT"
    who = F.concat(F.lit("t"), F.col("id"))

    def rows(ids, route, step, day):
        time = F.lit(f"2024-01-0{day}").cast("timestamp")
        return entity_rows(spark.range(*ids), name, route, step, time, assignment_id=F.col("id").cast("string"), target_identity_id=who)

    changes = rows((0, 20), "CREATE", 0, 1).unionByName(rows((0, 5), "DELETE", 1, 2))
    state = apply_changes(spark.createDataFrame([], ENTITIES[name].schema), changes, ENTITIES[name])
    assert "MapInArrow" not in state._jdf.queryExecution().toString()
    assert sorted(int(r[0]) for r in state.select("assignment_id").collect()) == list(range(5, 20))
    # A row of another identity under a stored key has to be walked.
    more = rows((5, 6), "CREATE", 2, 3).withColumn("target_identity_id", F.lit("other"))
    state = apply_changes(spark.createDataFrame([], ENTITIES[name].schema), changes.unionByName(more), ENTITIES[name])
    assert "MapInArrow" in state._jdf.queryExecution().toString()
    assert {r[0]: r[1] for r in state.select("assignment_id", "target_identity_id").collect()}["5"] == "other"


def collection_rows(spark, ids, route, step, **values):
    columns = {"member_global_id": F.concat(F.lit("m"), "id"), "id": F.col("id").cast("string"), **values}
    return entity_rows(spark.range(*ids), "GLOBAL_IDENTITY_COLLECTION", route, step, F.lit("2024-01-01").cast("timestamp"), **columns)


def test_a_load_keeps_the_columns_of_its_target(spark):
    entity = ENTITIES["GLOBAL_IDENTITY_COLLECTION"]
    kept = [c for c in entity.column_names if c in deciding_columns(entity) | {"name"}]
    changes = collection_rows(spark, (0, 9), "CREATE", 0).withColumn("name", F.lit("a")).unionByName(
        collection_rows(spark, (0, 3), "UPDATE", 1, member_operation_type=F.lit("remove"))
    ).unionByName(collection_rows(spark, (3, 4), "DELETE", 2, member_global_id=F.lit("")))
    empty = spark.createDataFrame([], entity.schema)
    wide = apply_changes(empty, changes, entity, dated=True)
    narrow = apply_changes(empty.select(*kept), changes.select(*kept, "_route", "_step", "_seq"), entity, dated=True, written=True)
    assert narrow.columns == kept and wide.columns == entity.column_names
    assert as_set(narrow.collect(), kept) == as_set(wide.collect(), kept)
    assert sorted(r["id"] for r in narrow.collect()) == ["4", "5", "6", "7", "8"]


def test_written_deletes_are_joined_only_where_there_are_any(spark):
    entity = ENTITIES["GLOBAL_IDENTITY_COLLECTION"]
    empty = spark.createDataFrame([], entity.schema)
    held = collection_rows(spark, (0, 9), "CREATE", 0)
    removed = collection_rows(spark, (0, 3), "UPDATE", 1, member_operation_type=F.lit("remove"))

    def joins(changes):
        return apply_changes(empty, changes, entity, dated=True, written=True)._jdf.queryExecution().analyzed().toString().count("Join LeftAnti")

    assert joins(held) == 0
    assert joins(held.unionByName(removed)) == 1


def test_delete_keys_are_not_sorted(spark):
    entity = ENTITIES["GLOBAL_IDENTITY_COLLECTION"]
    changes = collection_rows(spark, (0, 9), "CREATE", 0).unionByName(collection_rows(spark, (0, 3), "DELETE", 1))
    plan = apply_changes(spark.createDataFrame([], entity.schema), changes, entity, dated=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_members_are_written_without_columns_nobody_reads(spark, tmp_path, monkeypatch):
    rows = [(1, 5, 1, "N"), (1, 6, 2, "R"), (2, 5, 1, "R"), (2, 5, 4, "A"), (3, 7, 3, "R")]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    written = []
    monkeypatch.setattr(queries_state, "stage", lambda df, name: written.append((name, df.columns)) or stage(df, name))
    state = queries_state.membership_apply(spark, str(tmp_path))
    got = sorted(tuple(r) for r in state.collect())
    assert got == [("1", "", "change"), ("1", "5", "change"), ("2", "", "change"), ("2", "5", "change"), ("3", "", "change")]
    assert sorted(name for name, _ in written) == ["changes", "changes", "state"]
    assert all("attributes" not in columns and {"id", "member_global_id", "name"} <= set(columns) for _, columns in written)
