import datetime as dt

import pytest
from pyspark.sql import functions as F

from grantlake.entities import AUDIT, ENTITIES, entity
from grantlake.operators import offsets as off
from grantlake.operators import rejects as rej
from grantlake.operators import snapshot as snap
from grantlake.operators.flatten import flatten
from grantlake.sinks.tables import HistoryTable, LedgerTable, StateTable, create_tables
from tests.events import decoded

ROLE = ENTITIES["ROLE"]


def roles(spark, *ids, operation="CREATE"):
    return flatten(decoded(spark, *[("ROLE", {"id": i}, operation) for i in ids]), "ROLE")


def files(folder):
    return sorted(p for p in folder.rglob("*.parquet"))


def test_loads_append_and_a_compaction_rewrites(spark, tmp_path):
    state = StateTable(spark, str(tmp_path), ROLE)
    state.create()
    assert state.read().count() == 0
    state.load(roles(spark, *[f"r{i}" for i in range(40)]))
    first = files(tmp_path / "ROLE_STATE" / "changes")
    state.load(roles(spark, "r1", operation="DELETE"))
    # The second load leaves the first one's files alone and writes one row.
    second = [f for f in files(tmp_path / "ROLE_STATE" / "changes") if f not in first]
    assert set(first) < set(files(tmp_path / "ROLE_STATE" / "changes"))
    assert spark.read.parquet(*map(str, second)).count() == 1
    assert state.read().count() == 39
    state.load(roles(spark, "new"), "feed", 3)
    assert not state.load(roles(spark, "new", operation="DELETE"), "feed", 3)
    rows = sorted(r["id"] for r in state.read().collect())
    assert "new" in rows and len(rows) == 40
    assert state.compact() and not state.compact()
    assert [x.kind for x in state.loads.read()] == ["applied", "base"] or [x.kind for x in state.loads.read()] == ["base", "applied"]
    assert sorted(r["id"] for r in state.read().collect()) == rows
    assert state.applied("feed", 3) and not state.applied("feed", 4)
    # What the first compaction replaced goes with the next one.
    assert files(tmp_path / "ROLE_STATE" / "changes")
    state.load(roles(spark, "new", operation="DELETE"), "feed", 4)
    assert state.compact() and state.read().count() == 39
    assert not first[0].exists()


def test_a_load_is_not_dealt_by_its_groups(spark, tmp_path):
    net = StateTable(spark, str(tmp_path), ROLE)._net(roles(spark, "a", "b"))
    plan = net._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r["id"], r["_group"]) for r in net.collect()) == [("a", 1), ("b", 1)]


def test_a_load_that_was_not_published_is_not_seen(spark, tmp_path):
    state = StateTable(spark, str(tmp_path), ROLE)
    state.load(roles(spark, "a"), "feed", 0)
    state._net(roles(spark, "b")).write.parquet(f"{state.path}/changes/load=2/attempt=lost")
    assert [r["id"] for r in state.read().collect()] == ["a"]
    state.load(roles(spark, "b"), "feed", 1)
    assert sorted(r["id"] for r in state.read().collect()) == ["a", "b"]
    undated = roles(spark, "c").withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    with pytest.raises(Exception, match="needs an event time"):
        state.load(undated)


def scanned(frame):
    """Files that the scans of a plan opened."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    frame.explain("formatted")
    found, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "TableCacheQueryStageExec"):
            todo.append(node.plan())
            continue
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found, plan


def test_readers_of_one_tenant_or_key_open_a_fraction_of_the_files(spark, tmp_path):
    state = StateTable(spark, str(tmp_path), ROLE, part_rows=2)
    events = [("ROLE", {"id": f"r{i}"}) for i in range(400)]
    rows = flatten(decoded(spark, *events), "ROLE").withColumn("tenancy_id", F.concat(F.lit("t"), F.substring("id", 2, 1)))
    state.load(rows)
    state.compact()
    everything, _ = scanned(state.read())
    assert everything >= 60
    tenant, plan = scanned(state.read(tenancy_id="t3"))
    assert "PartitionFilters: [isnotnull(_tenant" in plan and "EqualTo(tenancy_id,t3)" in plan
    key, _ = scanned(state.read(id="r33"))
    both, _ = scanned(state.read(tenancy_id="t3", id="r33"))
    assert 0 < tenant < everything / 2 and 0 < key < everything / 4 and both == 1
    assert {r["id"] for r in state.read(tenancy_id="t3").collect()} == {r["id"] for r in state.read().filter("tenancy_id = 't3'").collect()}
    state.load(roles(spark, "r33", operation="DELETE").withColumn("tenancy_id", F.lit("t3")))
    assert state.read(id="r33").count() == 0 and state.read(tenancy_id="t3").count() == 110
    with pytest.raises(ValueError, match="no key column of ROLE: name"):
        state.read(name="x")


def test_a_removal_of_stale_rows_concerns_earlier_loads(spark, tmp_path):
    state = StateTable(spark, str(tmp_path), ROLE)
    state.load(roles(spark, "a", "b"))
    state.compact()
    state.load(roles(spark, "c"))
    cutoff = spark.createDataFrame([("T", "S", dt.datetime(2026, 1, 1))], "scope_tenancy string, scope_service string, cutoff timestamp")
    state.remove_stale(cutoff)
    assert state.read().count() == 0
    state.load(roles(spark, "c", "d"))
    assert sorted(r["id"] for r in state.read().collect()) == ["c", "d"]
    state.compact()
    assert sorted(r["id"] for r in state.read().collect()) == ["c", "d"]


def test_history_files_do_not_grow_with_loads(spark, tmp_path):
    history = HistoryTable(spark, str(tmp_path), ROLE)
    days = 3
    for load in range(20):
        rows = roles(spark, *[f"r{load}-{i}" for i in range(30)]).repartition(6)
        rows = rows.withColumn("event_timestamp", F.expr(f"timestamp'2025-01-01 00:00:00' + make_dt_interval(pmod(hash(id), {days}))"))
        history.append(rows, f"feed-{load}")
        if load % 5 == 4:
            history.compact()
    dates = {}
    for load in history.loads.read():
        if load.kind == "rows":
            for f in files(tmp_path / "ROLE_TS" / "rows" / load.folder):
                dates[f.parent.name] = dates.get(f.parent.name, 0) + 1
    assert len(dates) == days and max(dates.values()) <= 2
    assert history.read().count() == 600
    history.append(roles(spark, "again"), "feed-3")
    assert history.read().count() == 600 and history.read().select("id").distinct().count() == 600


def test_create_and_recreate(spark, tmp_path):
    create_tables(spark, str(tmp_path), history=False)
    state = StateTable(spark, str(tmp_path), ROLE)
    state.load(roles(spark, "a"))
    create_tables(spark, str(tmp_path), history=False)
    assert state.read().count() == 1
    assert not (tmp_path / "ROLE_TS").exists() and (tmp_path / "AUDIT_EVENTS").exists()
    state.create(recreate=True)
    assert state.read().count() == 0 and state.read().schema == ROLE.schema


def test_history_keeps_duplicates_and_replays_once(spark, tmp_path):
    history = HistoryTable(spark, str(tmp_path), ROLE)
    history.create()
    for load in ("1", "2", "2"):
        history.append(roles(spark, "a", "a"), load)
    assert history.read().count() == 4
    assert HistoryTable(spark, str(tmp_path), AUDIT).path.endswith("/AUDIT_EVENTS")


def test_rejects(spark):
    events = decoded(
        spark,
        ("APPROVAL_WORKFLOW", {"id": "ok", "name": "é" * 2000}),
        ("APPROVAL_WORKFLOW", {"id": "long", "name": "é" * 2000 + "x"}),
        ("APPROVAL_WORKFLOW", {"id": "number", "version": "one"}),
    )
    checked = rej.with_reason(flatten(events, "APPROVAL_WORKFLOW"), entity("APPROVAL_WORKFLOW"))
    assert [r["id"] for r in rej.valid_rows(checked).collect()] == ["ok"]
    reasons = {r["id"]: r["_reason"] for r in rej.rejected_rows(checked).collect()}
    assert reasons == {
        "long": "value too large for column name (maximum 4000)",
        "number": "invalid number in column version",
    }
    assignment = entity("PERMISSION_ASSIGNMENT")
    rows = flatten(decoded(spark, ("PERMISSION_ASSIGNMENT", {"add": [{"status": "x" * 300}, {"id": ""}]}, "UPDATE")), assignment.name, history=True)
    kept = rej.with_reason(rows, assignment, state=False)
    assert sorted(r["_reason"] or "" for r in kept.collect()) == ["", "value too large for column status (maximum 256)"]
    assert rej.with_reason(rows, assignment).filter("_reason is not null").count() == 2


def at(n):
    return dt.datetime(2025, 1, n)


def _files(spark, *rows):
    ddl = "message_type string, tenancy_id string, service_instance_id string, snapshot_id string, batch_id string, event_timestamp timestamp, _step int"
    return spark.createDataFrame([("ROLE", *r) for r in rows], ddl)


def test_snapshot_ledger(spark):
    ledger = snap.register_batches(
        snap.empty_ledger(spark),
        snap.ledger_rows(_files(spark, ("T", None, "s", "b1", at(3), 1), ("T", "", "s", "b1", at(1), 2), ("T", None, "s", "b2", at(2), 3))),
    )
    ledger = snap.register_batches(ledger, snap.ledger_rows(_files(spark, ("T", None, "s", "b2", at(9), 0))))
    assert sorted((r["service_instance_id"], r["batch_id"], r["updated_at"]) for r in ledger.collect()) == [
        ("-", "b1", at(3)), ("-", "b2", at(2))
    ]

    def ready(n):
        marker = _files(spark, ("T", None, "s", "m", at(9), 9)).withColumn("num_of_batches", F.lit(n))
        return snap.ready_snapshots(ledger, snap.pending_rows(marker))

    assert ready(3).count() == 0
    assert [r["cutoff"] for r in ready(2).collect()] == [at(2)]
    assert snap.clear_ledger(ledger, ready(2)).count() == 0
    assert snap.ready_snapshots(snap.empty_ledger(spark), snap.empty_pending(spark)).count() == 0


def test_stale_rows_by_scope(spark):
    state = spark.createDataFrame(
        [("a", "T", "S", at(1)), ("b", "T", "S", at(2)), ("c", "U", "S", at(1)), ("d", "T", "X", at(1)), ("e", "", "S", at(1)), ("f", "T", "S", None)],
        "id string, tenancy_id string, service_instance_id string, event_timestamp timestamp",
    )

    def left(*cutoffs):
        ready = spark.createDataFrame(list(cutoffs), "scope_tenancy string, scope_service string, cutoff timestamp")
        return "".join(sorted(r["id"] for r in snap.remove_stale(state, ready).collect()))

    assert left(("T", "S", at(2))) == "bcdef"
    assert left(("T", None, at(2))) == "bcef"
    assert left((None, "S", at(2))) == "bdf"
    assert left((None, None, at(3))) == "f"
    assert left(("", "S", at(3))) == "abcdef"
    assert left(("T", "S", at(2)), ("U", "S", at(2)), ("T", "S", at(3))) == "def"


def test_offsets(spark):
    now = F.lit(at(2)).cast("timestamp")
    ledger = off.open_range(off.empty_offsets(spark), "app", 0, 9, F.lit(at(1)).cast("timestamp"))
    resume = lambda frame, app="app": off.resume_offset(frame, app, now).first()[0]
    assert resume(off.empty_offsets(spark)) == 0
    assert resume(ledger) == 0 and off.unfinished_ranges(ledger, "app", now).count() == 1
    ledger = off.complete_range(ledger, "app", 0, 9, now)
    assert resume(ledger) == 9 and resume(ledger, "other") == 0
    ledger = off.open_range(ledger, "app", 10, 19, now)
    # Opened just now, so not yet given up: go on after it.
    assert off.unfinished_ranges(ledger, "app", now).count() == 0 and resume(ledger) == 19
    assert [r["id"] for r in ledger.orderBy("id").collect()] == [1, 2]
    assert off.last_offset(ledger, "app").first()[0] == 19


def test_ledger_table(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "l"), "a int")
    assert table.read().count() == 0
    table.replace(spark.createDataFrame([(1,)], "a int"), "feed", 4)
    table.replace(table.read().union(spark.createDataFrame([(2,)], "a int")))
    assert sorted(r[0] for r in table.read().collect()) == [1, 2]
    assert table.applied("feed", 4) and not table.applied("feed", 5)
