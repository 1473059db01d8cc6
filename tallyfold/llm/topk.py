"""Exact top-k search by inner product, score at a time over an impact-ordered index.

Vectors are split into blocks, queries into blocks, and each pair of blocks is one group.
In a group every dimension has its rows in segments of like values. For a query, a
segment's impact is the most that one of its rows can add to the score; segments are
processed by descending impact. A row's score is at most what it has gathered, plus the
dimensions still open times the impact reached. The rows best so far are scored exactly,
and the k-th of them is a threshold: once few rows could still reach it, those are scored
exactly too, and the rest are proven not to be members. Nothing else ends the processing,
so results are exact; ties go to the smaller id.

Defined results: vectors that are null or hold a null or a non-finite component, or whose
id is null, take no part; shorter vectors count as padded with zeros; an exact repetition
of a row counts once; rows of the query's own id are no candidates; no queries give no
rows. Where a score could leave 64 bits the group is scored in unbounded integers, and a
score that does leave them, or a component that does after scaling, is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RESULT = "query_id long, vec_id long, score long"


class ImpactIndex:
    """Segments of every dimension of a block: rows, and the range of their values."""

    def __init__(self, vectors: np.ndarray, segments: int = 4):
        n, dims = vectors.shape
        edges = np.unique(np.linspace(0, n, min(segments, n) + 1).astype(np.int64))
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy() if n else np.zeros((dims, 0), np.int64)
        self.starts, self.ends = edges[:-1], edges[1:]
        ranked = np.take_along_axis(vectors, self.order.T, axis=0)
        self.low, self.high = ranked[self.starts].T, ranked[self.ends - 1].T  # dims x segments
        self.vectors, self.values = vectors, ranked.T.copy()

    def top(self, query: np.ndarray, k: int, banned: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
        """``(score, row)`` of the k best rows that are not banned."""
        n, dims = self.vectors.shape
        impact = np.maximum(self.low * query[:, None], self.high * query[:, None])
        queue = np.argsort(-impact, axis=None, kind="stable")
        flat = impact.ravel()[queue]
        gathered, open_ = np.zeros(n, np.int64), np.full(n, dims, np.int64)
        # Scoring a quarter of the rows exactly costs less than shutting out more of them.
        few, step, at = max(32, n // 4), max(1, len(queue) // 12), 0
        possible = np.flatnonzero(~banned)
        while at < len(queue) and len(possible) > few:
            for segment in queue[at : at + step].tolist():
                d, s = divmod(segment, len(self.starts))
                begin, end = self.starts[s], self.ends[s]
                rows = self.order[d, begin:end]
                gathered[rows] += query[d] * self.values[d, begin:end]
                open_[rows] -= 1
            at += step
            rest = int(flat[at]) if at < len(queue) else 0
            # Every open dimension adds at most the impact that comes next.
            bound = gathered + open_ * rest
            best = possible[np.argpartition(-gathered[possible], min(k, len(possible)) - 1)[:k]]
            threshold = (self.vectors[best] @ query).min() if len(best) == k else None
            if threshold is not None:
                possible = possible[bound[possible] >= threshold]
        scores = self.vectors[possible] @ query
        chosen = np.lexsort((ids[possible], -scores))[:k]
        return [(int(scores[i]), int(possible[i])) for i in chosen]


def scaled(embedding: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component, computed as double; null if the vector takes no part."""
    doubles = embedding.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    bound = F.lit(float(1 << 63))
    too_large = F.raise_error(F.lit("a component leaves 64 bits after scaling")).cast("long")
    whole = F.transform(doubles, lambda x: F.when(F.abs(x * scale) < bound, F.floor(x * scale)).otherwise(too_large))
    return F.when(F.coalesce(~bad, F.lit(False)), whole)


def _exact(matrix: np.ndarray, other: np.ndarray) -> bool:
    """Whether sums of products of the two might leave 64 bits."""
    most = [max((abs(int(x.min())), abs(int(x.max()))), default=0) if x.size else 0 for x in (matrix, other)]
    return most[0] * most[1] * max(1, matrix.shape[1]) >= 1 << 62


def _scored_whole(rows: np.ndarray, asked: np.ndarray, ids: np.ndarray, names: list[int], k: int) -> list[tuple[int, int, int]]:
    """Results of a group in unbounded integers, all rows scored."""
    found = []
    for query_id, query in zip(names, asked.astype(object), strict=True):
        scores = [(-sum(a * b for a, b in zip(row, query, strict=True)), i) for row, i in zip(rows.astype(object), ids.tolist(), strict=True) if i != query_id]
        for score, i in sorted(scores)[:k]:
            if not -(1 << 63) <= -score < 1 << 63:
                raise ValueError("a score leaves 64 bits")
            found.append((query_id, i, -score))
    return found


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    block_rows: int = 8192,
    block_queries: int = 2048,
    segments: int = 4,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for the rows where ``is_query``."""
    whole = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding"), scale).alias("v"))
        .filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
        .distinct()
    )
    queries = whole.filter(F.coalesce(is_query, F.lit(False)))
    n, n_queries = whole.count(), queries.count()
    blocks, query_blocks = -(-n // block_rows) or 1, -(-n_queries // block_queries) or 1
    spread = lambda by, count: F.pmod(F.xxhash64(by, F.lit("block")), F.lit(count)).cast("int")
    left = whole.select(
        spread("vec_id", blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"), "vec_id", "v"
    )
    right = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), spread("vec_id", query_blocks).alias("part"), "vec_id", "v"
    )

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        dims = max([0, *map(len, rows["v"]), *map(len, asked["v"])])
        found = []
        if len(rows) and len(asked):
            own, queries_, ids = _matrix(rows["v"], dims), _matrix(asked["v"], dims), rows["vec_id"].to_numpy()
            if _exact(own, queries_):
                wide = _scored_whole(own, queries_, ids, asked["vec_id"].tolist(), k)
                return pd.DataFrame(wide, columns=["query_id", "vec_id", "score"]).astype("int64")
            index = ImpactIndex(own, segments)
            for query_id, query in zip(asked["vec_id"], queries_, strict=True):
                found += [(query_id, ids[row], score) for score, row in index.top(query, k, ids == query_id, ids)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    best = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(search, RESULT)
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
