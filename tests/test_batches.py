import hashlib
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.render import update_json
from tallyfold.operators.batches import chunk_updates, pack_batches
from tests.helpers import UPDATE, T0


def rows_of(spark):
    random.seed(5)
    rows = []
    for batch in range(40):
        for pos in range(random.randint(1, 9)):
            # One client sends more than half of everything; some send without a name.
            client = random.choice(["hot", "hot", "hot", "b", None])
            kind = random.choice([("counter", random.randint(0, 9), None), ("gauge", None, random.random())])
            rows.append((Decimal(batch * 2**31 + pos), batch, pos, T0, client, "batch", f"m{pos}", *kind))
    return rows, spark.createDataFrame(rows, UPDATE)


@pytest.mark.parametrize("group_rows", [10, 60, 10**6])
@pytest.mark.parametrize("size", [1, 7, 100])
def test_chunks_are_running_positions(spark, group_rows, size):
    rows, frame = rows_of(spark)
    position, expected = {}, {}
    for row in sorted(rows):
        client = row[4] or "unknown"
        expected[row[0]] = (client, position.get(client, 0) // size)
        position[client] = position.get(client, 0) + 1
    got = {r.seq: (r.client, r.chunk) for r in chunk_updates(frame, size, group_rows).collect()}
    assert got == expected


def test_packed_bodies(spark):
    rows, frame = rows_of(spark)
    packed = pack_batches(chunk_updates(frame, 10, 50), "key").collect()
    assert sum(r.updates for r in packed) == len(rows)
    assert max(r.updates for r in packed) == 10
    for client in ("hot", "b", "unknown"):
        sent = [u for r in sorted(packed, key=lambda r: r.chunk) if r.client == client for u in json.loads(r.body)]
        want = []
        for row in sorted(rows):
            if (row[4] or "unknown") == client:
                record = {"id": row[6], "type": row[7]}
                record.update({"delta": row[8]} if row[8] is not None else {"value": row[9]})
                want.append(record)
        assert sent == want
    for r in packed:
        assert r.digest == hashlib.sha256((r.body + "key").encode()).hexdigest()
    assert pack_batches(chunk_updates(frame)).first().digest is None


def test_one_client_with_all_rows_is_dealt_out(spark):
    frame = spark.range(5000).selectExpr(
        "cast(id as decimal(38,0)) as seq", "id as batch_id", "0 as pos", "'hot' as client"
    )
    chunked = chunk_updates(frame, 100, 1000)
    assert [r.chunk for r in chunked.orderBy("seq").collect()] == [i // 100 for i in range(5000)]
    folders = chunked.inputFiles()
    sizes = [r["count"] for r in spark.read.parquet(*folders).groupBy("_range").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 2000


def test_numbers_and_text_of_bodies(spark):
    cases = [
        (10.0, "10"), (1e-5, "0.00001"), (1e-7, "1e-7"), (1.5e-10, "1.5e-10"), (1e20, "100000000000000000000"),
        (1e21, "1e+21"), (123456.789, "123456.789"), (0.1, "0.1"), (0.0, "0"), (-2.5, "-2.5"), (5e-324, "5e-324"),
        (1234567.0, "1234567"), (0.000123, "0.000123"), (float("nan"), None), (float("inf"), None),
    ]
    frame = spark.createDataFrame([(v, w) for v, w in cases], "v double, w string")
    text = update_json(F.lit("a<&>"), F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.col("v"))
    for r in frame.select("w", text.alias("t")).collect():
        assert r.t == (None if r.w is None else '{"id":"a\\u003c\\u0026\\u003e","type":"","value":' + r.w + "}")
