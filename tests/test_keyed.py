from pyspark.sql import functions as F

import pytest

from tallyfold.operators.fold import fold_updates, merge_states
from tallyfold.operators.lookup import answer_lookups, frequent_keys
from tallyfold.streaming import keyed
from tests.helpers import UPDATE, state, updates, values
from tests.test_streaming import feed, sample


@pytest.fixture
def session(spark):
    return keyed.rocksdb_session(spark)


def stream(session, folder):
    return session.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(folder)


def rows(frame):
    return sorted(tuple(r) for r in frame.select("name", "metric_type", "gauge_value", "counter_value", "gauge_seq").collect())


@pytest.mark.parametrize("full_every", [0, 1, 2])
def test_changes_equal_the_batch_fold_over_a_restart(session, tmp_path, full_every):
    parts = [sample(40 * i, 40) for i in (3, 0, 2, 1)]
    run = lambda: keyed.run_state_changes(stream(session, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", full_every=full_every).awaitTermination()
    for part in parts[:2]:
        feed(session, f"{tmp_path}/in", part)
    run()
    for part in parts[2:]:
        feed(session, f"{tmp_path}/in", part)
    run()
    want = fold_updates(updates(session, sum(parts, [])))
    assert sorted(map(str, keyed.read_changes(session, f"{tmp_path}/out").collect())) == sorted(map(str, want.collect()))


def test_resumed_state_over_a_restart_and_a_replay(session, tmp_path):
    restored = state(session, [("m0", "counter", None, 100), ("m1", "gauge", 7.5, None), ("idle", "counter", None, 2**62), ("m9", "gauge", 1.0, None)])
    restored = restored.withColumns({"first_seen": F.lit(None).cast("timestamp_ntz"), "gauge_seq": F.lit(None).cast("decimal(38,0)")})
    one, two = sample(0, 50), [*sample(50, 50), (200, 0, "idle", "counter", 2**62, None), (200, 1, "idle", "counter", 5, None)]
    start = lambda: keyed.run_resumed_changes(stream(session, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", restored).awaitTermination()
    feed(session, f"{tmp_path}/in", one)
    start()
    feed(session, f"{tmp_path}/in", two)
    start()
    want = merge_states(restored, fold_updates(updates(session, one + two)))
    assert rows(keyed.read_changes(session, f"{tmp_path}/out")) == rows(want)
    got = values(keyed.read_changes(session, f"{tmp_path}/out"))
    assert got["idle", "counter"] == 2**62 + 2**62 + 5 - 2**64 and got["m9", "gauge"] == 1.0


def test_a_replayed_epoch_and_a_half_written_full_state_change_nothing(session, tmp_path):
    path = f"{tmp_path}/out"
    first, second = (fold_updates(updates(session, sample(s, 30))) for s in (0, 30))
    keyed._write(first, path, False, 0)
    keyed._write(first, path, False, 0)
    before = rows(keyed.read_changes(session, path))
    assert before == rows(first)
    keyed._write(first.limit(1), path, True, 0)  # no later epoch: it may be half written
    assert rows(keyed.read_changes(session, path)) == before
    keyed._write(first, path, True, 0)
    keyed._write(second.limit(2), path, False, 1)
    changed = {r[:2]: r for r in rows(second.limit(2))}
    assert rows(keyed.read_changes(session, path)) == sorted({**{r[:2]: r for r in before}, **changed}.values())


def test_a_million_equal_requests_without_other_columns_are_many_tasks(spark):
    some = state(spark, [("PollCount", "counter", None, 1), ("CMD", "gauge", 10.5, None), ("rare", "counter", None, 3)])
    equal = spark.range(1_000_000, numPartitions=16).selectExpr("'PollCount' as name", "'counter' as metric_type")
    others = spark.range(300).selectExpr("if(id % 3 = 0, 'rare', concat('none', id)) as name", "if(id % 50 = 0, null, 'counter') as metric_type")
    answers = answer_lookups(equal.unionByName(others), some)
    assert frequent_keys(equal.unionByName(others)) == ["9:PollCountcounter"]
    tasks = answers.where("name = 'PollCount'").groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert len(tasks) >= 8 and sum(r["n"] for r in tasks) == 1_000_000
    got = {(r["http_status"], r["counter_value"]): r["n"] for r in answers.groupBy("http_status", "counter_value").agg(F.count("*").alias("n")).collect()}
    rare = sum(1 for i in range(300) if i % 3 == 0 and i % 50)
    unknown = sum(1 for i in range(300) if i % 50 == 0)
    assert got == {(200, 1): 1_000_000, (200, 3): rare, (200, None): unknown, (404, None): 300 - rare - unknown}
