import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import topk as K


def brute(rows, k, every):
    ok = {
        (i, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, x in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=5, every=10, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit("x"))
    got = K.top_k(frame, F.col("vec_id") % every == 0, k, **options)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "block_queries": 9, "segments": 5}])
def test_equals_brute_force(spark, options):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(400, 600)]  # a third are copies, so ties
    rows += [(700, None), (710, [1.0, None]), (720, [float("nan")] * 16), (730, [float("inf")] * 16), (None, rows[0][1])]
    rows += [(40, rows[40][1]), (740, [0.0] * 16), (750, [1.0, -2.0]), (760, [])]
    assert run(spark, rows, **options) == brute(rows, 5, 10)


@pytest.mark.parametrize("seed", range(5))
def test_index_is_exact(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-40, 40, (900, 8)) * rng.integers(0, 2, (900, 8))
    ids = rng.permutation(900)
    index = K.ImpactIndex(vectors, 16)
    for q in range(20):
        scores = vectors @ vectors[q]
        banned = ids == ids[q]
        want = sorted((-scores[i], ids[i]) for i in range(900) if not banned[i])[:5]
        assert [(-s, ids[row]) for s, row in index.top(vectors[q], 5, banned, ids)] == want


def test_fewer_than_k_and_none(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, []) == []


def test_large_components_are_scored_whole(spark):
    rows = [(0, [1e5, 1.0]), (1, [1e8, 0.0]), (2, [1e8, 1.0]), (3, [-1e8, 5.0]), (50, [0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = K.top_k(vectors, F.col("vec_id") == 0).collect()
    scaled = {i: [int(256 * x) for x in v] for i, v in rows}
    want = sorted(((-sum(a * b for a, b in zip(scaled[0], scaled[i])), i) for i in scaled if i))
    assert [(-r["score"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"])] == want
