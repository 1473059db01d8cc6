import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import quality_classifier as Q
from tests.llm.rows import awkward_docs, no_docs


def corpus(spark, n=400):
    rows = []
    for i in range(n):
        words = [f"w{(i * 7 + k * k) % 97}x" for k in range(60 + i % 40)]
        good = i % 3 > 0
        rows.append((i, " ".join(words) if good else "### ".join(words), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_held_out_accuracy(spark):
    rows = corpus(spark)
    trees = Q.train(rows.select("doc_id", "text"), rows.select("doc_id", "label"))
    scored = Q.score(rows, trees).withColumn("held_out", Q.held_out(F.col("doc_id"))).collect()
    held = [r for r in scored if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all((r["score"] >= 0.3) == bool(r["label"]) for r in held)


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows = corpus(spark, 120)
    labels = rows.select("doc_id", "label")
    flipped = labels.withColumn("label", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("label")).otherwise(F.col("label")))
    docs = rows.select("doc_id", "text")
    a, b = Q.train(docs, labels), Q.train(docs, flipped)
    assert all(np.array_equal(x, y) for x, y in zip(a, b))


def slow_score(trees, row):
    total = trees.base
    for feature, limit, value in zip(trees.feature, trees.limit, trees.value):
        at = 0
        while at < len(limit):
            at = 2 * at + 1 + int(row[feature[at]] > limit[at])
        total += value[at - len(limit)]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_equal_a_walk_by_row():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)).round(1)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = Q.fit(x, y, n_trees=20, depth=3)
    got = trees.score(x)
    assert np.allclose(got, [slow_score(trees, r) for r in x])
    assert ((got >= 0.5) == y).mean() > 0.97


def test_best_split_is_the_brute_force_one():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (80, 3)).astype(float)
    y = (x[:, 1] > 2).astype(float)
    tree = Q.fit(x, y, n_trees=1, depth=1)
    assert tree.feature[0, 0] == 1 and tree.limit[0, 0] == 2


@pytest.mark.parametrize("labels", [[], [(4, 1)], [(4, None), (None, 1)], [(4, 0), (5, 1), (5, 0), (11, 1)]])
@pytest.mark.parametrize("extra", [False, True])
def test_awkward_documents(spark, labels, extra):
    docs = awkward_docs(spark, extra)
    trees = Q.train(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    rows = Q.score(docs, trees).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1


def test_sample_is_bounded(spark):
    rows = corpus(spark, 60)
    trees = Q.train(rows.select("doc_id", "text"), rows.select("doc_id", "label"), sample_rows=1)
    assert len(trees.feature) == 0


def test_no_rows(spark):
    trees = Q.train(no_docs(spark), spark.createDataFrame([], "doc_id long, label int"))
    assert Q.score(no_docs(spark), trees).count() == 0
