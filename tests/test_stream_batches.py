import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.classes import CLASSES
from tallyfold.operators import validate
from tallyfold.operators.batches import chunk_updates, pack_batches
from tallyfold.streaming import batches, judged
from tests.helpers import T0, UPDATE, updates
from tests.test_streaming import feed, sample, stream


def clients(seed, first, count):
    rng = random.Random(seed)
    return [
        (Decimal(first + i), first + i, 0, T0, rng.choice(["hot", "hot", "hot", "b", f"c{first}", None]), "batch", f"m{i}", "counter", rng.randint(0, 9), None)
        for i in range(count)
    ]


def put(spark, folder, rows):
    spark.createDataFrame(rows, UPDATE).coalesce(1).write.mode("append").parquet(folder)


def shown(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("size, full_every", [(1, 0), (7, 2)])
def test_stream_equals_batch_over_a_restart(spark, tmp_path, size, full_every):
    parts = [clients(i, 100 * i, 40) for i in range(4)]
    out = f"{tmp_path}/out"
    run = lambda: batches.run_batches(stream(spark, f"{tmp_path}/in"), out, f"{tmp_path}/checkpoint", size, "key", full_every).awaitTermination()
    so_far = []
    for two in (parts[:2], parts[2:]):
        for part in two:
            put(spark, f"{tmp_path}/in", part)
        run()
        so_far += sum(two, [])
        want = pack_batches(chunk_updates(spark.createDataFrame(so_far, UPDATE), size), "key")
        assert shown(batches.read_batches(spark, out, "key", waiting=True)) == shown(want)
        assert shown(batches.read_batches(spark, out)) == shown(want.where(F.col("updates") == size))


def test_a_replayed_epoch_sends_nothing_twice(spark, tmp_path):
    first, second = (spark.createDataFrame(clients(i, 100 * i, 30), UPDATE) for i in range(2))
    for frame, epoch in ((first, 0), (second, 1), (second, 1)):
        batches._deliver(frame, epoch, str(tmp_path), 4, "", 1)
    want = pack_batches(chunk_updates(first.union(second), 4))
    assert shown(batches.read_batches(spark, str(tmp_path), waiting=True)) == shown(want)


def test_late_updates_join_the_open_chunk_and_none_is_lost(spark, tmp_path):
    rows = clients(3, 0, 90)
    for epoch, part in enumerate((rows[60:], [], rows[:30], rows[30:60])):
        batches._deliver(spark.createDataFrame(part, UPDATE), epoch, str(tmp_path), 7, "", 2)
    bodies = batches.read_batches(spark, str(tmp_path), waiting=True).collect()
    sent = [u["id"] for r in bodies for u in json.loads(r.body)]
    assert sorted(sent) == sorted(r[6] for r in rows)
    for client in {r.client for r in bodies}:
        own = sorted((r.chunk, r.updates) for r in bodies if r.client == client)
        assert [c for c, _ in own] == list(range(len(own))) and all(n == 7 for _, n in own[:-1])


def test_nothing_sent_before_the_first_epoch(spark, tmp_path):
    assert batches._open_chunks(spark, str(tmp_path)).count() == 0


def test_counts_come_with_the_rows_of_a_stream(spark, tmp_path):
    bad = [(500, 0, "x", "histogram", 1, None), (501, 0, "x", "counter", None, None), (502, 0, "x", "gauge", None, None)]
    parts = [sample(0, 30), [*sample(30, 30), *bad]]
    for part in parts:
        feed(spark, f"{tmp_path}/in", part)
    rows = validate.classify(stream(spark, f"{tmp_path}/in"))
    for _ in range(2):  # the second run finds nothing new
        judged.run_judged(rows, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        want = validate.classify(updates(spark, sum(parts, []))).groupBy("update_class").agg(F.count("*").alias("updates"))
        assert shown(judged.read_class_counts(spark, f"{tmp_path}/out")) == shown(want)
    stored = spark.read.parquet(f"{tmp_path}/out/rows")
    assert stored.count() == 63 and stored.where("side = 'refused'").count() == 3
    assert {r.update_class for r in stored.select("update_class").distinct().collect()} <= set(CLASSES)
