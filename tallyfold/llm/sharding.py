"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``points`` places on a ring of 64-bit hashes; a key belongs to the next
place clockwise of its own hash. A shard takes no more keys than its capacity; those
beyond it go on clockwise, place by place, until a shard has room. Capacities add up to
the number of rows and differ by at most one, so row counts of shards do too.

Only counts per arc (``shards * points`` of them, however many rows) reach the driver.
There the walk is done on counts: in each round every place offers what it holds to its
shard, in the order of places, and passes on the rest. That gives each arc a few ranges
of ranks, each with its shard; rows find theirs by their rank in the arc, so no shard or
arc is gathered anywhere, and the place in the range is the slot in the shard.

Defined results: the key is the doc_id, so copies of a text are dealt out like any rows;
rows that share an id lie in one arc, ordered by text checksum and size; a null id has a
place of its own; a null text has size 16 and checksum 0; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.llm.common import set_aside


class Range(NamedTuple):
    """Ranks of an arc from ``first`` up to, not including, ``end`` go to ``shard`` from ``slot`` on."""

    arc: int
    first: int
    end: int
    shard: int
    slot: int


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ring(shards: int, points: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places and their shards. A shard's places do not depend on the number of shards."""
    shard, point = np.divmod(np.arange(shards * points, dtype=np.uint64), np.uint64(points))
    with np.errstate(over="ignore"):
        places = _mixed(_mixed(shard + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)) + point)
    order = np.lexsort((shard, places))
    return places[order], shard[order].astype(np.int64)


def capacities(rows: int, shards: int) -> np.ndarray:
    return rows // shards + (np.arange(shards) < rows % shards)


def walk(counts: np.ndarray, owners: np.ndarray, room: np.ndarray) -> list[Range]:
    """Ranges of ranks of every arc. Arcs that have walked as far are served in ring order."""
    left, given = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    room, filled = room.astype(np.int64).copy(), np.zeros(len(room), np.int64)
    ranges = []
    for steps in range(len(counts)):
        open_ = np.flatnonzero(left)
        if not len(open_):
            break
        for arc in open_[room[owners[(open_ + steps) % len(counts)]] > 0].tolist():
            shard = int(owners[(arc + steps) % len(counts)])
            taken = int(min(left[arc], room[shard]))
            if taken:
                ranges.append(Range(arc, int(given[arc]), int(given[arc]) + taken, shard, int(filled[shard])))
                left[arc] -= taken
                given[arc] += taken
                room[shard] -= taken
                filled[shard] += taken
    return ranges


@set_aside
def assign_shards(docs: DataFrame, shards: int = 40, points: int = 64, seed: int = 5) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``rows``: shards' row counts are at most one apart.
    """
    places, owners = ring(shards, points, seed)

    def arcs(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for h in hashes:
            yield pd.Series(np.searchsorted(places, h.to_numpy().view(np.uint64), side="left") % len(places)).astype("int32")

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("doc_id", F.lit(seed)).alias("h"),
    ).withColumn("arc", F.pandas_udf(arcs, "int")("h"))
    slim = docs.select(F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)).alias("h"))
    found = slim.select(F.pandas_udf(arcs, "int")("h").alias("arc")).groupBy("arc").count().collect()
    counts = np.zeros(len(places), np.int64)
    for row in found:
        counts[row["arc"]] = row["count"]
    ranges = walk(counts, owners, capacities(int(counts.sum()), shards))
    spark = docs.sparkSession
    table = spark.createDataFrame(ranges or [Range(-1, 0, 0, 0, 0)], "_arc int, first long, end long, shard int, at long")
    rank = F.row_number().over(W.partitionBy("arc").orderBy("h", "doc_id", "text_crc32", "size")) - 1
    ranked = keyed.withColumn("rank", rank.cast("long"))
    inside = (F.col("arc") == F.col("_arc")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    # The ranges are bounded by the ring: at most one per arc and one per shard it overflows to.
    return ranked.join(F.broadcast(table), inside).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("at") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
