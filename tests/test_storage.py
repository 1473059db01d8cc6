import json
import math
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from tallyfold.operators.lookup import all_gauges, point_lookup
from tallyfold.operators.snapshot import snapshot_documents
from tallyfold.plans.ingest import ingest_bodies
from tallyfold.sinks.audit_log import read_audit
from tallyfold.sinks.files import write_bodies
from tallyfold.sinks.snapshot import load_snapshot, newest_save, save_snapshot, write_document
from tallyfold.sinks.state_table import compact_state, restore_state, upsert_state
from tallyfold.sources.files import REQUEST, read_bodies, read_requests
from tallyfold.sources.snapshot import read_document, read_snapshot
from tallyfold.sources.state_table import read_state
from tests.helpers import T0, state, values


def test_upsert_is_idempotent_per_epoch(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_state(spark, path).count() == 0
    first = state(spark, [("a", "counter", None, 5), ("g", "gauge", 1.0, None, 1)])
    second = state(spark, [("a", "counter", None, 3), ("g", "gauge", 2.0, None, 2)])
    upsert_state(first, path, "w", 0)
    for _ in range(3):
        upsert_state(second, path, "w", 1)
    assert values(read_state(spark, path)) == {("a", "counter"): 8, ("g", "gauge"): 2.0}
    upsert_state(second, path, "another-writer", 0)
    assert values(read_state(spark, path))[("a", "counter")] == 11
    # Replays add nothing even after somebody else has written.
    upsert_state(second, path, "w", 1)
    upsert_state(first, path, "w", 0)
    assert values(read_state(spark, path))[("a", "counter")] == 11
    with pytest.raises(ValueError):
        upsert_state(first, path, "no/folder", 0)


def test_the_gauge_that_arrived_last_stays_whatever_the_order(spark, tmp_path):
    path = str(tmp_path / "state")
    for epoch, seq in enumerate((3, 1, 4, 2)):
        upsert_state(state(spark, [("g", "gauge", float(seq), None, seq)]), path, "w", epoch)
    assert values(read_state(spark, path)) == {("g", "gauge"): 4.0}


def test_a_job_killed_at_any_step_is_put_right_by_its_replay(spark, tmp_path):
    path, rows = str(tmp_path / "state"), [(f"m{i}", "counter", None, i) for i in range(50)]
    upsert_state(state(spark, [("a", "counter", None, 5)]), path, "w", 0)
    epoch = Path(path, "writer=w", "epoch=1")
    # Nothing but the folder of running tasks; then no rows; then all but the mark; then none.
    (epoch / "_temporary" / "0").mkdir(parents=True)
    assert values(read_state(spark, path)) == {("a", "counter"): 5}
    upsert_state(state(spark, rows), path, "w", 1)
    whole = values(read_state(spark, path))
    assert len(whole) == 51 and not (epoch / "_temporary").exists()
    for pattern in ("*.parquet", "_SUCCESS", "*"):
        for file in [f for f in epoch.rglob(pattern) if f.is_file()]:
            file.unlink()
        left = values(read_state(spark, path))
        assert left.items() <= whole.items() and left[("a", "counter")] == 5
        upsert_state(state(spark, rows), path, "w", 1)
        assert values(read_state(spark, path)) == whole


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_an_epoch_writes_its_own_keys_only(spark, tmp_path):
    path = str(tmp_path / "state")
    upsert_state(state(spark, [(f"m{i}", "counter", None, i) for i in range(200)]), path, "w", 0)
    before = files_of(path)
    upsert_state(state(spark, [("m7", "counter", None, 1)]), path, "w", 1)
    after = files_of(path)
    assert {f: after[f] for f in before} == before and len(after) == len(before) + 1
    plan = read_state(spark, path, name="m7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,m7)" in plan
    assert values(read_state(spark, path, name="m7")) == {("m7", "counter"): 8}


def test_files_follow_the_names(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = spark.range(4000).selectExpr(
        "concat('m', id) as name", "'counter' as metric_type", "cast(null as double) as gauge_value",
        "id as counter_value", "cast(null as timestamp_ntz) as first_seen", "cast(null as decimal(38,0)) as gauge_seq",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        upsert_state(rows, path, "w", 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f"{f}" for f in Path(path).rglob("*.parquet")]
    ranges = sorted(spark.read.parquet(f).selectExpr("min(name)", "max(name)").first()[0:2] for f in files)
    assert len(files) > 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_restore_only_begins_a_table(spark, tmp_path):
    path, found = str(tmp_path / "state"), state(spark, [("a", "counter", None, 5), ("g", "gauge", 1.0, None)])
    restore_state(found, path)
    for file in list(Path(path).rglob("*.parquet"))[:1]:
        file.unlink()
    restore_state(found, path)  # the first one died
    assert values(read_state(spark, path)) == {("a", "counter"): 5, ("g", "gauge"): 1.0}
    upsert_state(state(spark, [("a", "counter", None, 1), ("g", "gauge", 2.0, None)]), path, "w", 0)
    restore_state(found, path)
    assert values(read_state(spark, path)) == {("a", "counter"): 6, ("g", "gauge"): 2.0}


def test_compaction_keeps_replays_harmless(spark, tmp_path):
    old, new, newer = (str(tmp_path / n) for n in ("old", "new", "newer"))
    for writer in ("one", "two"):
        for epoch in range(4):
            rows = [("a", "counter", None, 1), ("g", "gauge", float(epoch), None), (f"m{epoch}", "counter", None, epoch)]
            upsert_state(state(spark, rows), old, writer, epoch)
    expected = values(read_state(spark, old))
    assert expected[("a", "counter")] == 8 and expected[("g", "gauge")] == 3.0
    compact_state(spark, old, new)
    assert values(read_state(spark, new)) == expected
    upsert_state(state(spark, [("a", "counter", None, 1), ("g", "gauge", 3.0, None), ("m3", "counter", None, 3)]), new, "one", 3)
    assert values(read_state(spark, new)) == expected
    upsert_state(state(spark, [("a", "counter", None, 1)]), new, "one", 4)
    compact_state(spark, new, newer)
    assert values(read_state(spark, newer)) == {**expected, ("a", "counter"): 9}
    folders = sorted(str(f.relative_to(newer)) for f in Path(newer).glob("*/*"))
    assert folders == ["writer=compacted/epoch=-1", "writer=one/epoch=4", "writer=two/epoch=3"]


def test_stored_state_is_pruned_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "state")
    upsert_state(state(spark, [("a", "counter", None, 5), ("g", "gauge", 1.0, None)]), path, "w", 0)
    plan = all_gauges(read_state(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "metric_type#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "counter_value" not in plan.split("ReadSchema:")[1]
    plan = point_lookup(read_state(spark, path), "gauge", "g")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,g)" in plan


ROWS = [("a", "counter", None, 5), ("a", "gauge", 1.5, None), ("zero", "gauge", 0.0, None), ("big", "counter", None, 2**63 - 1)]


def test_snapshot_round_trip(spark, tmp_path):
    path = str(tmp_path / "snap")
    assert load_snapshot(spark, path) is None
    for rows in ([("old", "gauge", 1.0, None)], ROWS[:2], ROWS):
        save_snapshot(state(spark, rows), path)
        assert values(load_snapshot(spark, path)) == {(n, t): g if t == "gauge" else c for n, t, g, c in rows}
    assert newest_save(spark, path).number == 2


def test_a_snapshot_counts_once_it_is_whole(spark, tmp_path):
    path = tmp_path / "snap"
    save_snapshot(state(spark, ROWS[:1]), str(path), "w", 0)
    save_snapshot(state(spark, ROWS), str(path), "w", 1)
    for file in (path / "turn=1" / "part=end").iterdir():  # died before its mark
        file.unlink()
    assert values(load_snapshot(spark, str(path))) == {("a", "counter"): 5}
    save_snapshot(state(spark, ROWS), str(path), "w", 1)
    assert len(values(load_snapshot(spark, str(path)))) == 4 and newest_save(spark, str(path)).epoch == 1


ODD = [('quo"te\\', "counter", None, 1), ("<a & b>\u2028\n\t", "gauge", -1e-7, None), ("counters", "gauge", 2.5e30, None),
       ("é:{", "gauge", 123456.789, None), ("}", "counter", None, -(2**63)), ("", "counter", None, 0), ("x" * 20000, "gauge", 1 / 3, None)]


def joined(path):
    return "".join(f.read_text() for f in sorted(path.glob("part-*")))


def test_one_document_over_many_files(spark, tmp_path):
    rows = [*ROWS, *ODD, *[(f"m{i}", "counter", None, i) for i in range(3000)]]
    unwritten = [("nan", "gauge", math.nan, None), ("inf", "gauge", math.inf, None), (None, "counter", None, 3), ("t", "other", 1.0, 1)]
    write_document(state(spark, rows + unwritten), str(tmp_path / "d"))
    document = json.loads(joined(tmp_path / "d"))
    assert document["counters"] == {n: c for n, t, g, c in rows if t == "counter"}
    assert document["gauges"] == {n: g for n, t, g, c in rows if t == "gauge"}
    back = read_document(spark, str(tmp_path / "d"))
    assert values(back) == {(n, t): g if t == "gauge" else c for n, t, g, c in rows}
    # One file cut into many pieces gives the same.
    (tmp_path / "one.json").write_text(joined(tmp_path / "d"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        pieces = read_document(spark, str(tmp_path / "one.json"))
        assert pieces.rdd.getNumPartitions() > 8
        assert rows_of(pieces) == rows_of(back)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_indented_documents_of_others(spark, tmp_path):
    def read(text):
        path = tmp_path / "save.json"
        path.write_text(text)
        found = values(read_document(spark, str(path)))
        if text.strip():
            assert found == values(read_snapshot(spark, str(path), one_per_line=False))
        return found

    whole = {"counters": {"PollCount": 5, "gauges": 7}, "gauges": {"CMD": 12.34, "n": 3, "s": 1e-7}}
    turned = {"gauges": whole["gauges"], "counters": whole["counters"]}
    expected = {("PollCount", "counter"): 5, ("gauges", "counter"): 7, ("CMD", "gauge"): 12.34, ("n", "gauge"): 3.0, ("s", "gauge"): 1e-7}
    for document in (whole, turned):
        for indent in ("\t", 2):
            assert read(json.dumps(document, indent=indent)) == expected
    text = json.dumps(whole, indent="\t")
    assert read(text[:-1]) == read(text.replace("5", "1.5")) == read(text.replace("12.34", "oops")) == {}
    assert read(json.dumps({"counters": {}, "gauges": {"g": 1}}, indent="\t")) == {("g", "gauge"): 1.0}
    assert read(json.dumps({"counters": {}, "gauges": {}}, indent="\t")) == read("") == {}


def test_what_json_has_not_is_left_out_and_counted(spark):
    rows = [("nan", "gauge", math.nan, None), ("inf", "gauge", math.inf, None), ("ok", "gauge", 1.0, None), (None, "counter", None, 3)]
    documents = snapshot_documents(state(spark, rows)).collect()
    assert sum(d.skipped for d in documents) == 3 and len(documents) == 4


def test_empty_state(spark, tmp_path):
    write_document(state(spark, []), str(tmp_path / "d"))
    assert json.loads(joined(tmp_path / "d")) == {"counters": {}, "gauges": {}}
    assert read_document(spark, str(tmp_path / "d")).count() == 0
    save_snapshot(state(spark, []), str(tmp_path / "s"))
    assert load_snapshot(spark, str(tmp_path / "s")).count() == 0


def test_documents_gather_nothing(spark):
    frame = snapshot_documents(state(spark, [(f"m{i}", "counter", None, i) for i in range(50)]))
    assert frame.count() == 50
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_foreign_snapshots(spark, tmp_path):
    def read(text):
        path = tmp_path / "save.json"
        path.write_text(text)
        return values(read_snapshot(spark, str(path), one_per_line=False))

    document = {"counters": {"PollCount": 5}, "gauges": {"CMD": 12.34, "n": 3}}
    assert read(json.dumps(document, indent="\t")) == {
        ("PollCount", "counter"): 5, ("CMD", "gauge"): 12.34, ("n", "gauge"): 3.0,
    }
    assert read("") == {}
    assert read("{broken") == {}
    assert read('{"counters":{"a":1.5},"gauges":{"g":1}}') == {}
    assert read('{"counters":null}') == {}
    assert read('{"gauges":{"g":1}}') == {("g", "gauge"): 1.0}


def test_gzip_round_trip(spark, tmp_path):
    path = tmp_path / "bodies"
    write_bodies(spark.createDataFrame([("[1]",), ("[2]",)], "body string"), str(path))
    assert list(path.glob("*.gz")) and not list(path.glob("*.txt"))
    assert sorted(r.body for r in read_bodies(spark, str(path)).collect()) == ["[1]", "[2]"]


def test_write_path(spark, tmp_path):
    bodies = [
        (0, T0, "c", "", '[{"id":"a","type":"counter","delta":5},{"id":"g","type":"gauge","value":1.5}]'),
        (1, T0, "c", "", '[{"id":"a","type":"counter","delta":1},{"id":"a","type":"counter"}]'),
        (2, T0, None, "", '[{"id":"a","type":"counter","delta":2},{"id":"h","type":"x"}]'),
        (3, T0, "c", "", "nonsense"),
        (4, T0, "c", "", "[]"),
    ]
    spark.createDataFrame(bodies, REQUEST).write.option("compression", "gzip").json(str(tmp_path / "in"))
    requests = read_requests(spark, str(tmp_path / "in"))
    cases = ({"on_invalid": "reject_batch"}, 7), ({}, 8), ({"store": "table"}, 7), ({"on_invalid": "apply_prefix", "store": "table"}, 8)
    for number, (options, total) in enumerate(cases):
        base = tmp_path / str(number)
        paths = [str(base / p) for p in ("state", "audit", "staging")]
        for _ in range(2):  # a replay changes nothing
            ingest_bodies(requests, *paths, writer="w", epoch=0, **options)
        assert values(read_state(spark, paths[0])) == {("a", "counter"): total, ("g", "gauge"): 1.5}
        assert sorted((r.metrics, r.ip_address) for r in read_audit(spark, paths[1]).collect()) == [
            ([], "c"), (["a", "g"], "c"), (["a", "h"], "unknown"),
        ]
