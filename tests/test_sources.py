import base64
import datetime as dt
import json

from pyspark.sql import functions as F

from grantlake.plans import queries_sources
from grantlake.plans.registry import QUERIES
from grantlake.sources import files as src
from grantlake.sources.headers import supported_events, tolerant_bool, tolerant_int
from grantlake.sources.messages import decode_messages, message_events
from tests.events import header, lines


def test_header_lines_accumulate_and_line_order_survives_splits(spark, tmp_path):
    body = [{"id": f"r{i:04d}", "pad": "x" * 200} for i in range(500)]
    text = lines(header("ROLE", correlationId="one", numOfBatches="7"), *body[:250])
    later = json.dumps({"headers": {"correlationId": "two", "numOfBatches": "many", "isDay0": True}})
    (tmp_path / "a b.jsonl").write_text(text + "\n" + later + "\n\n" + "\n".join(json.dumps(b) for b in body[250:]))
    (tmp_path / "other.jsonl").write_text(lines(header("POLICY", "UPDATE"), {"headers2": 1, "x": {"headers": 5}}))
    (tmp_path / "skip.txt").write_text("nothing")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = src.read_lines(spark, str(tmp_path))
        assert read.select("_block").distinct().count() > 3
        files = {r["object_name"]: r for r in src.line_files(read, str(tmp_path)).collect()}
        events = src.line_events(read, root=str(tmp_path)).orderBy("_step", "_seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(files) == {"a b.jsonl", "other.jsonl"}
    a = files["a b.jsonl"]
    # A header that cannot be read as a number does not replace one that can.
    assert (a["snapshot_id"], a["num_of_batches"], a["is_day0"], a["batch_id"]) == ("two", 7, True, "a b")
    mine = [json.loads(e["raw"])["id"] for e in events if e["message_type"] == "ROLE"]
    assert mine == [b["id"] for b in body]
    assert {(e["operation"], e["operation_type"]) for e in events} == {("CREATE", "EXPORT"), ("UPDATE", "UPDATE")}


def test_ids_without_correlation(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "b1.jsonl").write_text(lines(header("ROLE"), {"id": "r"}))
    event = src.line_events(src.read_lines(spark, str(tmp_path)), root=str(tmp_path)).first()
    assert (event["batch_id"], event["snapshot_id"]) == ("b1", "deep/b1.jsonl")


def test_completion_marker_needs_no_data_a_number_and_the_status(spark, tmp_path):
    done = {"status": " completed ", "numOfBatches": "2"}
    (tmp_path / "yes.jsonl").write_text(lines(header("ROLE", **done)))
    (tmp_path / "data.jsonl").write_text(lines(header("ROLE", **done), {"id": "r"}))
    (tmp_path / "number.jsonl").write_text(lines(header("ROLE", status="COMPLETED", numOfBatches="x")))
    (tmp_path / "status.jsonl").write_text(lines(header("ROLE", status="IN_PROGRESS", numOfBatches="2")))
    read = src.read_lines(spark, str(tmp_path))
    files, events = src.line_files(read), src.line_events(read)
    assert [r["batch_id"] for r in src.completion_markers(files, events).collect()] == ["yes"]
    assert src.snapshot_files(files, events).count() == 4


def test_envelopes(spark, tmp_path):
    head = header("ROLE")
    for name, data in {
        "object": {"id": "o"},
        "list": [{"id": "l1"}, {"id": "l2"}],
        "text": json.dumps([{"id": "t"}]),
        "number": 5,
        "broken": "{",
    }.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"headers": head, "data": data}, indent=1))
    events = src.envelope_events(src.read_envelopes(spark, str(tmp_path))).collect()
    ids = [json.loads(e["raw"])["id"] for e in events if e["raw"] != "{"]
    assert sorted(ids) == ["l1", "l2", "o", "t"]
    assert events[0]["event_timestamp"] == dt.datetime(2025, 1, 1)


def _message(payload, layers=2):
    raw = json.dumps(payload).encode()
    for _ in range(layers):
        raw = base64.b64encode(raw).rstrip(b"=")
    return raw.decode()


def test_messages(spark):
    def message(kind, operation, version, data, **more):
        head = {**header(kind, operation, "2025-01-01T02:00:00.123456789+02:00"), "eventTypeVersion": version, **more}
        return _message({"headers": head, "data": json.dumps(data)})

    rows = [
        (0, message("ROLE", "UPDATE", "9.9", {"id": "refused"})),
        (1, message("ROLE", "DELETE", "1.0", {"id": "a"})),
        (2, message("POLICY", "DELETE", "1.0", {"id": "p"})),
        (3, message("ROLE", "UPDATE", "1.0", [{"id": "b"}, {"id": "c"}])),
        (4, _message({"data": "{}"})),
        (5, "%%%"),
        (6, message("WIDGET", "CREATE", "1.0", {"id": "w"})),
    ]
    frame = spark.createDataFrame(rows, "pos int, value string")
    events = supported_events(message_events(decode_messages(frame), ["pos"]))
    got = events.select("message_type", "_step", F.get_json_object("raw", "$.id").alias("id"), "event_timestamp").orderBy("id").collect()
    # Updates were seen first, in a message that is then refused.
    assert [(r["id"], r["_step"]) for r in got] == [("a", 2), ("b", 1), ("c", 1), ("p", 1)]
    assert got[0]["event_timestamp"] == dt.datetime(2025, 1, 1, 0, 0, 0, 123456)


def test_payload_that_is_json_text(spark):
    twice = _message({"headers": header("ROLE"), "data": json.dumps(json.dumps([{"id": "a"}, {"id": "b"}]))})
    frame = spark.createDataFrame([(0, twice), (1, _message({"headers": header("ROLE"), "data": json.dumps("no payload")}))], "pos int, value string")
    events = message_events(decode_messages(frame), ["pos"]).select(F.get_json_object("raw", "$.id")).collect()
    assert sorted(r[0] for r in events) == ["a", "b"]


def test_single_layer(spark):
    frame = spark.createDataFrame([(0, _message({"headers": header("ROLE"), "data": "{}"}, 1))], "pos int, value string")
    assert decode_messages(frame, layers=1).first()["data"] == "{}"


def test_tolerant_values(spark):
    frame = spark.createDataFrame([(" 12 ", " TRUE "), ("12.5", "yes"), ("x", None), (None, "true")], "n string, b string")
    got = frame.select(tolerant_int(F.col("n")), tolerant_bool(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(12, True), (None, False), (None, False), (None, True)]


def test_slots_of_a_day_and_type_share_feed_files(spark, tmp_path, monkeypatch):
    # Two events of each thousand ids, so that a file per thousand would hold two lines; some have no id or day.
    rows = [(i * 500, dt.datetime(2024, 1, 1), 7, "view", 1.0, "{}") for i in range(300)]
    rows += [(None, dt.datetime(2024, 1, 1), 8, "view", 1.0, "{}"), (3, None, 9, "view", 1.0, "{}")]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))

    def written():
        path = queries_sources.write_feed(spark, str(tmp_path))
        return spark.read.option("recursiveFileLookup", "true").text(path).select("_metadata.file_path").distinct().count()

    assert written() == 2
    monkeypatch.setattr(queries_sources, "FILE_LINES", 100)
    assert written() == 4
    got = QUERIES["feed_file_scan"](spark, str(tmp_path)).collect()
    assert sorted((int(r["id"]), r["position"]) for r in got if r["user_id"] == 7) == [(i * 500, i % 2 + 1) for i in range(300)]
    assert sorted((r["id"] or "", r["user_id"], r["position"]) for r in got if r["user_id"] != 7) == [("", 8, 1), ("3", 9, 1)]
