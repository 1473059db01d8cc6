import datetime
from decimal import Decimal
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.audit import audit_bodies
from tallyfold.operators.fold import fold_updates
from tallyfold.operators.report import polls_per_report, report_windows
from tallyfold.operators.validate import applied_updates, judge_batches
from tallyfold.sinks.audit_log import append_audit, read_audit
from tallyfold.sinks.snapshot import load_snapshot, save_snapshot
from tallyfold.sources.files import REQUEST, stream_requests
from tallyfold.sources.state_table import read_state
from tallyfold.sources.updates import parse_batches
from tallyfold.streaming.audit import run_audit
from tallyfold.streaming.report import (
    read_polls_per_report,
    read_report_windows,
    run_polls_per_report,
    run_report_windows,
)
from tallyfold.streaming.state import continuous_state, run_snapshots, run_state_table
from tests.helpers import T0, UPDATE, state, updates, values


def sample(start=0, count=60):
    random.seed(start)
    return [
        (start + i, 0, f"m{random.randint(0, 3)}", *random.choice([("counter", random.randint(-5, 9), None), ("gauge", None, random.random())]))
        for i in range(count)
    ]


def feed(spark, folder, rows):
    """One more input file."""
    updates(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(folder)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_stream_state_equals_batch_state(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in range(3):
        feed(spark, folder, sample(part * 60))
    query = (
        continuous_state(stream(spark, folder)).writeStream.outputMode("complete").format("memory")
        .queryName("continuous").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 2
    assert rows_of(spark.table("continuous")) == rows_of(fold_updates(spark.read.parquet(folder)))


def test_state_table_survives_restart_and_replay(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "state", "c"))
    snapshot = str(tmp_path / "snapshot")
    save_snapshot(state(spark, [("m0", "counter", None, 1000), ("old", "gauge", 4.5, None)]), snapshot)

    def run():
        run_state_table(stream(spark, folder), path, checkpoint, "w", snapshot=snapshot).awaitTermination()

    def expected():
        merged = values(fold_updates(spark.read.parquet(folder)))
        merged[("m0", "counter")] = merged.get(("m0", "counter"), 0) + 1000
        merged[("old", "gauge")] = 4.5
        return merged

    feed(spark, folder, sample(0))
    feed(spark, folder, sample(60))
    run()
    assert values(read_state(spark, path)) == expected()
    # As if the process died after the merge and before the commit of its epoch.
    last = max((int(p.name) for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit()))
    for name in (str(last), f".{last}.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    run()
    assert values(read_state(spark, path)) == expected()
    feed(spark, folder, sample(120))
    run()
    assert values(read_state(spark, path)) == expected()


def test_state_table_does_not_depend_on_the_order_of_files(spark, tmp_path):
    expected = None
    for number, order in enumerate(((0, 1, 2, 3), (1, 0, 3, 2))):
        folder = str(tmp_path / f"in{number}")
        for part in order:
            feed(spark, folder, sample(part * 60))
            run_state_table(stream(spark, folder), str(tmp_path / f"s{number}"), str(tmp_path / f"c{number}"), "w").awaitTermination()
        found = values(read_state(spark, str(tmp_path / f"s{number}")))
        assert found == values(fold_updates(spark.read.parquet(folder)))
        assert expected in (None, found)
        expected = found


def test_snapshots_of_a_stream(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "snapshot")
    for part in range(2):
        feed(spark, folder, sample(part * 60))
    run_snapshots(stream(spark, folder), path, str(tmp_path / "c"), "w", interval_seconds=0).awaitTermination()
    assert values(load_snapshot(spark, path)) == values(fold_updates(spark.read.parquet(folder)))


def polls(spark, folder, offsets):
    rows = [
        (Decimal(i), 0, i, T0 + datetime.timedelta(seconds=s), client, "batch", "PollCount", "counter", i, None)
        for i, (s, client) in offsets
    ]
    spark.createDataFrame(rows, UPDATE).coalesce(1).write.mode("append").parquet(folder)


def test_reports_count_every_poll_however_late(spark, tmp_path):
    folder = str(tmp_path / "in")
    first = [(3, (10.0, "a")), (4, (11.0, "b")), (5, (45.0, "a"))]
    late = [(0, (0.0, "a")), (1, (2.0, "a")), (2, (9.9, "a")), (6, (3.0, "a")), (7, (70.0, "b")), (8, (10.5, "b"))]

    def run():
        for name, start in (("polls", run_polls_per_report), ("newest", run_report_windows)):
            start(stream(spark, folder), str(tmp_path / name), str(tmp_path / f"c-{name}"), "w").awaitTermination()

    for rows in (first, late[3:], late[:3]):
        polls(spark, folder, rows)
        run()
    got = {((r.window_start - T0).seconds, r.client): r.polls for r in read_polls_per_report(spark, str(tmp_path / "polls")).collect()}
    assert got == {(0, "a"): 4, (10, "a"): 1, (10, "b"): 2, (40, "a"): 1, (70, "b"): 1}
    got = {((r.window_start - T0).seconds, r.client): r.delta for r in read_report_windows(spark, str(tmp_path / "newest")).collect()}
    assert got == {(0, "a"): 6, (10, "a"): 3, (10, "b"): 8, (40, "a"): 5, (70, "b"): 7}
    assert rows_of(read_polls_per_report(spark, str(tmp_path / "polls"))) == rows_of(polls_per_report(spark.read.parquet(folder)))


def test_reports_in_batch(spark):
    rows = [
        (Decimal(i), 0, i, T0 + datetime.timedelta(seconds=2 * i), "a", "batch", "PollCount", "counter", i % 5 + 1, None)
        for i in range(15)
    ]
    frame = spark.createDataFrame(rows, UPDATE)
    assert sorted(r.polls for r in polls_per_report(frame).collect()) == [5, 5, 5]
    newest = report_windows(frame).orderBy("window_start").collect()
    assert [r.delta for r in newest] == [5, 5, 5]
    # Reported poll counts, folded as counter updates, give the number of polls.
    total = fold_updates(frame.join(spark.createDataFrame([(r.seq,) for r in newest], "seq decimal(38,0)"), "seq"))
    assert values(total) == {("PollCount", "counter"): 15}


def test_request_stream_feeds_state_and_audit(spark, tmp_path):
    folder = str(tmp_path / "in")
    for batch in range(4):
        items = [{"id": "a", "type": "counter", "delta": batch}, {"id": "g", "type": "gauge", "value": float(batch)}]
        body = json.dumps(items) if batch != 2 else json.dumps([*items, {"id": "a", "type": "counter"}])
        spark.createDataFrame([(batch, T0, "c", "", body)], REQUEST).write.mode("append").option(
            "compression", "gzip"
        ).json(folder)
    judged = judge_batches(parse_batches(stream_requests(spark, folder, files_per_trigger=1)))
    run_state_table(applied_updates(judged), str(tmp_path / "state"), str(tmp_path / "c1"), "w").awaitTermination()
    assert values(read_state(spark, str(tmp_path / "state"))) == {("a", "counter"): 4, ("g", "gauge"): 3.0}
    failures = iter([True])

    def shaky(events, epoch):
        if next(failures, False):
            raise OSError("once")
        append_audit(events, str(tmp_path / "two"), "w", epoch)

    sinks = [shaky, lambda events, epoch: append_audit(events, str(tmp_path / "one"), "w", epoch)]
    with pytest.raises(Exception, match="audit sinks failed"):
        run_audit(audit_bodies(judged), sinks, str(tmp_path / "c2")).awaitTermination()
    run_audit(audit_bodies(judged), sinks, str(tmp_path / "c2")).awaitTermination()
    for name in ("one", "two"):
        events = read_audit(spark, str(tmp_path / name)).collect()
        assert [r.metrics for r in events] == [["a", "g"]] * 3
