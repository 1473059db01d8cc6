"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are learnt on the driver from a bounded sample of labelled rows
(``sample_rows``, those of the least keyed hash, so the same rows each time) and flattened
into arrays; every document is then scored where it lies, all documents of a batch going
down a tree together.

Defined results: a null or empty text has all statistics 0 and is scored like any other;
a label that is null is none, and of several labels of a document the greatest counts;
of repeated rows with one doc_id the least statistics are learnt from; with labels of
fewer than two kinds the score is their smoothed share; a null doc_id is held out only as
its text, the empty string, says.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import set_aside

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "lower", "upper", "digit", "blank", "newline",
    "punctuation", "symbol", "beyond_ascii", "unique_words", "words_not_alnum", "short_words",
    "repeated_lines", "line_bytes", "lines_per_word", "bars",
)


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    for kind, chars in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n",
         b".,;:!?'\"()-", b"#*$%&|<>@^~_=+/\\[]{}`", bytes(range(128, 256))),
        start=1,
    ):
        kinds[np.frombuffer(chars, np.uint8)] = kind
    return kinds


_KINDS = _kinds()


def statistics(text: str | None) -> np.ndarray:
    """The numbers named in STATISTICS for a whole text."""
    data = (text or "").encode()
    if not data:
        return np.zeros(len(STATISTICS))
    counts = np.bincount(_KINDS[np.frombuffer(data, np.uint8)], minlength=9)[1:] / len(data)
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, m = max(1, len(words)), max(1, len(lines))
    return np.array(
        [
            np.log1p(len(data)), np.log1p(len(words)), sum(map(len, words)) / n, *counts,
            len(set(words)) / n, sum(not w.isalnum() for w in words) / n, sum(len(w) < 4 for w in words) / n,
            1 - len(set(lines)) / m, len(data) / m, m / n, words.count(b"|") / n,
        ]
    )


class Trees(NamedTuple):
    """Complete trees of one depth, flattened: node i has children 2i+1 and 2i+2."""

    depth: int
    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # go right above it
    value: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += value[at - len(limit)]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15,
    least_weight: float = 2.0, ridge: float = 1.0,
) -> Trees:
    """Boosting on the logistic loss; every split is found from per-bin sums."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    inner, features = (1 << depth) - 1, x.shape[1] if x.ndim == 2 else 0
    if len(np.unique(y)) < 2:
        return Trees(depth, base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(features)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    offsets = np.arange(features) * bins
    total = np.full(len(y), base)
    trees = []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-total))
        grad, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            place = ((at - first)[:, None] * (features * bins) + offsets + binned).ravel()
            sums = [
                np.bincount(place, np.repeat(v, features), width * features * bins).reshape(width, features, bins)
                for v in (grad, weight)
            ]
            (g, h), (gt, ht) = [s.cumsum(2) for s in sums], [s.sum(2, keepdims=True) for s in sums]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[(h < least_weight) | (ht - h < least_weight)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for node in range(width):
                j, b = divmod(int(best[node]), bins)
                if gain[node, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + node], limit[first + node] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
        leaf = at - inner
        g, h = (np.bincount(leaf, v, inner + 1) for v in (grad, weight))
        value = -rate * g / (h + ridge)
        total += value[leaf]
        trees.append((feature, limit, value))
    return Trees(depth, base, *(np.array(part) for part in zip(*trees, strict=True)))


def held_out(doc_id: Column) -> Column:
    """Rows kept away from learning: crc32 of the id as text is divisible by five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, seed: int = 11, **options) -> Trees:
    """Trees from at most ``sample_rows`` labelled rows that are not held out.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1).
    """
    sample = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_rows)
        .select(F.col("doc_id").alias("_id"), "label")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([statistics(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found, batch.column(2)], names=["doc_id", "x", "label"])

    rows = (
        docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))  # sample_rows at most
        .select(F.col("doc_id").cast("long"), "text", F.col("label").cast("int"))
        .mapInArrow(run, "doc_id long, x array<double>, label int")
        .groupBy("doc_id").agg(F.min("x").alias("x"), F.first("label").alias("label"))
        .toPandas().sort_values("doc_id")
    )
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(STATISTICS))
    return fit(x, rows["label"].to_numpy(float), **options)


@set_aside
def score(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``score``; replaces a column of that name."""
    own = [c for c in docs.columns if c not in (text_col, "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column("_text")]).reshape(-1, len(STATISTICS))
            scored = pa.array(np.round(trees.score(x), 9))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), scored], names=[*own, "score"])

    fed = docs.select(*own, F.col(text_col).alias("_text"))
    schema = fed.drop("_text").schema.add("score", "double")
    return fed.mapInArrow(run, schema)


def accuracy(scored: DataFrame, labels: DataFrame, limit: float = 0.3) -> pd.DataFrame:
    """Held-out counts by label and prediction; four rows at most."""
    joined = scored.filter("held_out").join(labels, "doc_id")
    return joined.groupBy("label", (F.col("score") >= limit).cast("int").alias("predicted")).count().toPandas()
