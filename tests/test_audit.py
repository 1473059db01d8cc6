import json

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.audit import audit_batches, audit_bodies, audit_single
from tallyfold.operators.validate import classify, judge_batches
from tallyfold.sinks.audit_log import append_audit, fan_out, read_audit, read_indented_audit
from tallyfold.sources.updates import parse_batches
from tests.helpers import T0, one_by_one, updates

SECONDS = 1704067200


def test_single_events(spark):
    frame = one_by_one(spark, [("a", "counter", 1, None), ("b", "gauge", None, None), ("c", "gauge", None, 1.0)])
    frame = frame.withColumn("client", F.when(F.col("name") != "c", F.col("client")))
    got = sorted(tuple(r) for r in audit_single(classify(frame)).collect())
    assert got == [(SECONDS, ["a"], "10.0.0.0"), (SECONDS + 120, ["c"], "unknown")]


def test_batch_events(spark):
    rows = [
        (0, 0, "b", "counter", 1, None), (0, 1, "a", "histogram", None, None), (0, 2, "b", "gauge", None, 1.0),
        (1, 0, "a", "counter", None, None), (1, 1, "b", "counter", 1, None),
    ]
    judged = classify(updates(spark, rows))
    got = [(r.batch_id, r.metrics, r.ip_address) for r in audit_batches(judged).collect()]
    assert got == [(0, ["b", "a", "b"], "10.0.0.0")]
    listed = spark.createDataFrame([(0, T0, "x"), (1, T0, "x"), (2, T0, None)], "batch_id bigint, ts timestamp_ntz, client string")
    got = sorted(tuple(r) for r in audit_batches(judged, listed).collect())
    assert got == [(0, SECONDS, ["b", "a", "b"], "x"), (2, SECONDS, [], "unknown")]


def test_body_events(spark):
    bodies = ['[{"id":"b","type":"counter","delta":1},{"id":"h","type":"x"}]', "[]", '[{"id":"b","type":"gauge"}]', "oops"]
    rows = spark.createDataFrame([(i, T0, "c", b) for i, b in enumerate(bodies)], "batch_id int, ts timestamp_ntz, client string, body string")
    got = [tuple(r) for r in audit_bodies(judge_batches(parse_batches(rows))).collect()]
    assert sorted(got) == [(SECONDS, [], "c"), (SECONDS, ["b", "h"], "c")]


def test_times_do_not_depend_on_the_session_zone(spark):
    frame = one_by_one(spark, [("a", "counter", 1, None)]).withColumn("ts", F.expr("TIMESTAMP_NTZ'2024-07-01 12:00:00.9'"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert audit_single(classify(frame)).first().ts == 1719835200
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_log_holds_each_epoch_once(spark, tmp_path):
    events = audit_single(classify(one_by_one(spark, [("a", "counter", 1, None)])))
    for epoch in (0, 1, 1):
        append_audit(events, str(tmp_path / "log"), "w", epoch)
    assert [tuple(r) for r in read_audit(spark, str(tmp_path / "log")).collect()] == [(SECONDS, ["a"], "10.0.0.0")] * 2


def test_indented_events_without_separators(spark, tmp_path):
    events = [
        {"ts": 1, "metrics": ["a}{", "b\n}"], "ip_address": "x"},
        {"ts": 2, "metrics": [], "ip_address": "}"},
        {"ts": 3, "metrics": ["c"], "ip_address": "unknown"},
    ]
    (tmp_path / "audit.json").write_text("".join(json.dumps(e, indent="\t") for e in events))
    got = read_indented_audit(spark, str(tmp_path / "audit.json")).orderBy("ts").collect()
    assert [r.asDict() for r in got] == events


def test_fan_out_reaches_all_sinks(spark):
    events = audit_single(classify(one_by_one(spark, [("a", "counter", 1, None)])))
    seen = []

    def broken(rows, epoch):
        raise RuntimeError("down")

    def good(rows, epoch):
        seen.append((rows.count(), epoch))

    with pytest.raises(ExceptionGroup):
        fan_out([good, broken, good])(events, 3)
    assert seen == [(1, 3), (1, 3)]
