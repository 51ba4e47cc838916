import base64
import json
import os
from contextlib import contextmanager
from datetime import datetime
from pathlib import Path
from threading import Event

import pytest
from pyspark.sql import functions as F

from grantlake.entities import AUDIT, ENTITIES, entity
from grantlake.plans import load
from grantlake.plans.jobs import run
from grantlake.plans.load import load_state
from grantlake.plans.queries_sources import write_feed
from grantlake.sinks.tables import HistoryTable, RejectTable, StateTable
from grantlake.streaming.feeds import FeedConfig
from tests.events import decoded, header, lines

ROLE = ENTITIES["ROLE"]


class Feed:
    """A feed folder whose files arrive in the order they are written."""

    def __init__(self, root):
        self.root, self.clock = root, 1_700_000_000
        (root / "in").mkdir()
        self.reports = []

    def file(self, name, text):
        path = self.root / "in" / name
        path.write_text(text)
        self.clock += 10
        os.utime(path, (self.clock, self.clock))

    def config(self, name="job", **more):
        return FeedConfig(
            str(self.root / "in"), str(self.root / "tables"), str(self.root / f"progress-{name}"),
            on_report=self.reports.append, **more
        )

    def run(self, spark, name, **more):
        run(spark, name, self.config(name, **more)).awaitTermination()

    def state(self, spark, entity=ROLE):
        return StateTable(spark, str(self.root / "tables"), entity).read()


def test_files_to_state_with_snapshot(spark, tmp_path):
    feed = Feed(tmp_path)
    feed.file("old.jsonl", lines(header("ROLE", time="2024-12-01T00:00:00Z", correlationId="old"), {"id": "gone"}, {"id": "kept"}))
    feed.file("b1.jsonl", lines(header("ROLE", correlationId="s", isDay0="true"), {"id": "kept", "name": "1"}, {"id": "dropped"}))
    feed.file("del.jsonl", lines(header("ROLE", "DELETE", time="2025-01-01T00:00:05Z"), {"id": "dropped"}))
    # The marker comes before the last batch and has to wait for it.
    feed.file("end.jsonl", lines(header("ROLE", correlationId="s", status="COMPLETED", numOfBatches="2")))
    feed.run(spark, "file")
    assert sorted(r["id"] for r in feed.state(spark).collect()) == ["gone", "kept"]
    assert feed.reports[-1].finalized == []
    feed.file("b2.jsonl", lines(header("ROLE", time="2025-01-02T00:00:00Z", correlationId="s"), {"id": "second"}, {"id": "kept", "name": "2"}))
    feed.file("other.jsonl", lines({**header("ROLE"), "eventTypeVersion": "3.0"}, {"id": "refused"}))
    feed.run(spark, "file")
    assert feed.reports[-1].finalized == ["ROLE"] and feed.reports[-1].events == {"ROLE": 2}
    got = sorted((r["id"], r["name"], r["operation_type"]) for r in feed.state(spark).collect())
    assert got == [("kept", "2", "CREATE"), ("second", "", "CREATE")]
    feed.run(spark, "file")
    assert feed.state(spark).count() == 2


def test_envelope_files(spark, tmp_path):
    feed = Feed(tmp_path)
    feed.file("a.json", json.dumps({"headers": header("ROLE"), "data": [{"id": "a"}, {"id": "b"}]}, indent=1))
    feed.file("b.json", json.dumps({"headers": header("ROLE", "DELETE"), "data": json.dumps({"id": "a"})}))
    feed.file("c.json", json.dumps({"headers": {**header("ROLE"), "eventTime": None}, "data": {"id": "undated"}}))
    feed.run(spark, "file", envelopes=True)
    assert [r["id"] for r in feed.state(spark).collect()] == ["b"]
    assert feed.reports[-1].reasons == {"ROLE": [("no value for column event_timestamp", 1)]}


def test_small_batches_equal_one_batch(spark, tmp_path):
    states = []
    for part, max_files in (("one", 100), ("many", 1)):
        (tmp_path / part).mkdir()
        feed = Feed(tmp_path / part)
        for n in range(6):
            operation = ["CREATE", "UPDATE", "DELETE"][n % 3]
            ids = [f"r{(n * k) % 5}" for k in range(4)]
            feed.file(f"f{n}.jsonl", lines(header("ROLE", operation, time=f"2025-01-0{7 - n}T00:00:00Z"), *[{"id": i, "name": str(n)} for i in ids]))
        feed.run(spark, "file", max_files=max_files)
        states.append(sorted((r["id"], r["name"]) for r in feed.state(spark).collect()))
        assert len(feed.reports) == (1 if part == "one" else 6)
    assert states[0] == states[1] and states[0]


def test_files_to_history_and_unusable_rows(spark, tmp_path):
    feed = Feed(tmp_path)
    feed.file("a.jsonl", lines(header("ROLE"), {"id": "a"}, {"id": "a"}, {"id": "b", "createdOn": "x"}) + "\n{broken")
    feed.file("undated.jsonl", lines({**header("ROLE"), "eventTime": None}, {"id": "undated"}))
    feed.run(spark, "file_to_ts")
    kept = HistoryTable(spark, str(tmp_path / "tables"), ROLE).read().select("id", F.col("event_timestamp").isNull().alias("undated"))
    assert sorted(map(tuple, kept.collect())) == [("a", False), ("a", False), ("undated", True)]
    report = feed.reports[-1]
    assert (report.rows, report.rejected, report.malformed) == ({"ROLE": 3}, {"ROLE": 1}, 1)
    assert report.reasons == {"ROLE": [("invalid number in column created_on", 1)]}
    kept = RejectTable(spark, str(tmp_path / "tables")).read().select("load", "entity", "reason", "content").collect()
    assert sorted((r["load"], r["entity"], r["reason"]) for r in kept) == [
        ("history-file-0", "ROLE", "invalid number in column created_on"), ("history-file-0", "ROLE", "no JSON object")
    ]
    assert json.loads(next(r["content"] for r in kept if "number" in r["reason"]))["id"] == "b"


def test_every_event_is_loaded_rejected_or_skipped(spark, tmp_path):
    role = {"id": "a"}
    events = decoded(
        spark, ("ROLE", role), ("ROLE", {}, "CREATE"), ("ROLE", "[1]"), ("NOBODY", role), ("ROLE", role, "MOVE"),
        ("ROLE", role, "CREATE", "9.0"), ("AUDIT_EVENTS", role), ("ROLE", {"id": "b", "createdOn": 1.5}),
    )
    for _ in range(2):
        report = load_state(spark, events, str(tmp_path), "manual", 7)
    assert report.skipped == {
        "no JSON object": 1, "unknown type": 1, "unsupported operation": 1, "unsupported version": 1, "type of another job": 1
    }
    loaded, rejected = sum(report.rows.values()), sum(report.rejected.values())
    assert loaded + rejected + sum(report.skipped.values()) == events.count()
    kept = RejectTable(spark, str(tmp_path)).read()
    assert kept.count() == rejected + 4
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not [*shared.glob("rows-*"), *shared.glob("events-*")]


def test_messages_and_audit(spark, tmp_path):
    feed = Feed(tmp_path)

    def message(head, data):
        raw = json.dumps({"headers": head, "data": json.dumps(data)}).encode()
        return base64.b64encode(base64.b64encode(raw)).decode()

    group = ENTITIES["GLOBAL_IDENTITY_COLLECTION"]
    feed.file("m1", "\n".join([
        message(header(group.name, "UPDATE", time="2025-01-02T00:00:00Z"),
                {"id": "g", "add": {"members": [{"globalIdentityId": "x"}, {"globalIdentityId": "y"}]}, "remove": {"members": [{"globalIdentityId": "x"}]}}),
        message(header("AUDIT_EVENTS"), {"source": "s", "request": {"payload": {"selection": "password", "value": "p"}}}),
        "not a message",
    ]))
    feed.run(spark, "stream", max_files=1)
    assert feed.reports[0].skipped == {"no readable header": 1, "type of another job": 1}
    kept = RejectTable(spark, str(tmp_path / "tables")).read().collect()
    assert [(r["entity"], r["reason"], r["content"]) for r in kept] == [(None, "no readable header", "not a message")]
    feed.file("m2", message(header(group.name, "DELETE"), {"id": "g", "remove": {"members": [{"globalIdentityId": "y"}]}}))
    feed.run(spark, "stream", max_files=1)
    # A delete without a member deletes the group, and the flattened delete has a row without one.
    assert feed.state(spark, group).count() == 0
    feed.run(spark, "stream_to_ts")
    assert HistoryTable(spark, str(tmp_path / "tables"), group).read().count() == 6
    feed.run(spark, "audit")
    rows = HistoryTable(spark, str(tmp_path / "tables"), AUDIT).read().collect()
    assert [(r["source"], json.loads(r["request_payload"])["value"]) for r in rows] == [("s", ["***"])]


def test_loads_run_with_adaptive_execution(spark, tmp_path):
    feed = Feed(tmp_path)
    feed.file("a.jsonl", lines(header("ROLE"), {"id": "a"}))
    seen = []
    config = feed.config()
    config.on_report = lambda report: seen.append(report)
    import grantlake.streaming.feeds as feeds

    original = feeds.load_state

    def spy(session, events, *rest):
        seen.append(events.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return original(session, events, *rest)

    feeds.load_state = spy
    try:
        run(spark, "file", config).awaitTermination()
    finally:
        feeds.load_state = original
    assert seen[0] == "true"


def test_job_names_and_arguments(spark):
    with pytest.raises(ValueError, match="No job name"):
        run(spark, None, None)
    with pytest.raises(ValueError, match="Unknown job x"):
        run(spark, "x", None)
    with pytest.raises(ValueError, match="no path"):
        FeedConfig("", "r", "c")


def test_feed_files_of_slots_lie_side_by_side_and_are_listed_by_few_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = "id * 1000 as event_id, timestamp_ntz'2024-01-02 00:00:00' as ts, id as user_id, 'view' as event_type, 'p' as props"
    spark.range(40).selectExpr(*rows.split(", ")).write.parquet(f"{tmp_path}/in/events.parquet")
    path = write_feed(spark, f"{tmp_path}/in", path=f"{tmp_path}/feed", time="to_timestamp(day, 'yyyyMMdd')")
    files = list(Path(path).rglob("*.txt"))
    assert len(files) == 40 and {f.parent.parent for f in files} == {Path(path)}
    config = FeedConfig(path, f"{tmp_path}/lake", f"{tmp_path}/progress", glob="*.txt")
    run(spark, "file", config).awaitTermination()
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 64
    assert StateTable(spark, config.root, entity("RESOURCE")).read().count() == 40


def test_batches_without_a_marker_are_only_registered(spark, tmp_path, monkeypatch):
    names = []
    monkeypatch.setattr(load, "staged", lambda df, name, *by, f=load.staged: names.append(name) or f(df, name, *by))
    row = "RESOURCE", "CREATE", "1.0", "T", "S", "snap", datetime(2024, 1, 1)
    ddl = "message_type string, operation string, event_type_version string, tenancy_id string, service_instance_id string, snapshot_id string"
    files = spark.createDataFrame([(*row, "b1", None, False)], f"{ddl}, event_timestamp timestamp, batch_id string, num_of_batches int, is_marker boolean")
    files = files.withColumn("_step", F.col("event_timestamp"))
    assert load.finish_snapshots(spark, files, str(tmp_path), "file", 0) == [] and names == ["markers"]
    marker = files.withColumns({"is_marker": F.lit(True), "num_of_batches": F.lit(1)})
    assert load.finish_snapshots(spark, marker, str(tmp_path), "file", 1) == ["RESOURCE"]


def test_feed_files_of_neighbouring_slots_share_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = "(id % 300) * 1000 + id div 300 as event_id, timestamp_ntz'2024-01-02 00:00:00' as ts, id as user_id, 'view' as event_type, 'p' as props"
    spark.range(600).selectExpr(*rows.split(", ")).write.parquet(f"{tmp_path}/in/events.parquet")
    path = write_feed(spark, f"{tmp_path}/in", path=f"{tmp_path}/feed", time="to_timestamp(day, 'yyyyMMdd') + make_interval(0, 0, 0, 0, 0, 0, slot)")
    files = list(Path(path).rglob("*.txt"))
    assert len(files) == 300 and len({f.parent for f in files}) == 3
    for file in files:
        first, second, *data = [json.loads(line) for line in file.read_text().splitlines()]
        slots = {int(line["id"]) // 1000 for line in data}
        assert len(data) == 2 and len(slots) == 1
        minute, second_ = divmod(slots.pop(), 60)
        assert first["headers"]["eventTime"] == f"2024-01-02T00:{minute:02}:{second_:02}.000000789Z" and second == {"headers": {"correlationId": "snap-20240102"}}


def test_a_load_has_few_jobs(spark, tmp_path):
    feed, jobs = Feed(tmp_path), []
    for k in range(3):
        feed.file(f"f{k}.jsonl", lines(header("ROLE", time=f"2025-01-0{k + 1}T00:00:00Z"), {"id": "x", "name": str(k)}, {"id": str(k)}))
    config = feed.config(max_files=1)
    config.on_report = lambda report: jobs.append(spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs())
    run(spark, "file", config).awaitTermination()
    assert len(jobs) == 3 and jobs[2] - jobs[1] <= 27
    assert sorted((r["id"], r["name"]) for r in feed.state(spark).collect()) == [("0", ""), ("1", ""), ("2", ""), ("x", "2")]


def test_snapshots_are_registered_beside_the_tables_and_finished_after_them(spark, tmp_path, monkeypatch):
    entered, seen = Event(), []
    real = StateTable.load
    monkeypatch.setattr(StateTable, "load", lambda *a: seen.append(entered.wait(120)) or real(*a))

    @contextmanager
    def beside(events):
        entered.set()
        yield lambda: seen.append(StateTable(spark, str(tmp_path), ROLE).read().count())

    report = load_state(spark, decoded(spark, ("ROLE", {"id": "a"})), str(tmp_path), beside=beside)
    assert seen == [True, 1] and report.events == {"ROLE": 1} and report.rows == {"ROLE": 1}
