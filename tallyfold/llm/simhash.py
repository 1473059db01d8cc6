"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has 64 bits. Two that differ in at most ``max_bits`` of them agree on at
least ``blocks - max_bits`` of ``blocks`` equal parts, so each fingerprint is dealt out
once for every choice of that many parts, and only fingerprints that meet on a choice are
compared. Equal fingerprints are merged first: a group of copies is one fingerprint.

Inside one meeting place only the links of a spanning forest leave the task, so a dense
group never becomes all its pairs. A meeting place beyond ``max_bucket`` fingerprints is
linked through midpoints instead: two fingerprints differ in at most ``max_bits`` bits
exactly if some value lies within half of that of both, and all that lie so near one
value are linked to each other. That is exact, dealt over many tasks, and linear.

Defined results: a null or empty text has fingerprint zero and links like any other;
repeated rows and equal doc_ids each get their row; a null doc_id never names a
component unless all its documents have none; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import cut, set_aside

SEED = 42


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """Bits set in over half of the hashes of all word shingles, repeats included.

    ASCII letters are lower-cased; a text of fewer words is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    last = ends[min(shingle_words, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    step = 1 << 16  # bounds the memory a very long text takes
    for at in range(0, n, step):
        spans = zip(starts[at : min(n, at + step)].tolist(), last[at : at + step].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle_words: int = 4) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle_words) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    chosen = docs.select(F.col("doc_id").cast("long"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


def block_keys(fp: Column, blocks: int, max_bits: int) -> Column:
    """Every choice of blocks that must agree: ``which`` choice, and its bits as ``part``."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("which"),
                fp.bitwiseAND(F.lit(signed(sum(chosen)))).alias("part"),
            )
            for i, chosen in enumerate(combinations(masks, blocks - max_bits))
        ]
    )


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the distinct fingerprints: all that is near is reached."""
    left, links = fps, []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(left ^ at) <= max_bits
            if near.any():
                found = left[near]
                links += [(int(at), int(x)) for x in found]
                frontier += list(found)
                left = left[~near]
    return links


def _linked(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key (a group id for each row)."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[first, len(keys)])
    small = np.repeat(sizes, sizes) <= 32
    a, b = [], []
    for gap in range(1, 32):
        if gap >= len(fps):
            break
        meets = (keys[gap:] == keys[:-gap]) & small[gap:]
        if not meets.any():
            break
        at = np.flatnonzero(meets)
        at = at[np.bitwise_count(fps[at] ^ fps[at + gap]) <= max_bits]
        a.append(fps[at])
        b.append(fps[at + gap])
    for begin, size in zip(first[sizes > 32], sizes[sizes > 32], strict=True):
        links = np.array(_forest(fps[begin : begin + size], max_bits), np.uint64).reshape(-1, 2)
        a.append(links[:, 0])
        b.append(links[:, 1])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links_of_buckets(max_bits: int):
    """Over rows sorted by (which, part): links, holding one meeting place at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            which, part, fps = (batch.column(i).to_numpy() for i in range(3))
            fps = fps.view(np.uint64)
            if held:
                which, part, fps = (np.concatenate(x) for x in zip(held, (which, part, fps), strict=True))
            new = np.r_[False, (which[1:] != which[:-1]) | (part[1:] != part[:-1])]
            last = int(np.flatnonzero(new)[-1]) if new.any() else 0
            held = (which[last:], part[last:], fps[last:])
            if last:
                yield _batch(*_linked(np.cumsum(new[:last]), fps[:last], max_bits))
        if held:
            yield _batch(*_linked(np.zeros(len(held[2]), np.int64), held[2], max_bits))

    return run


def _batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _midpoint_stars(radius: int):
    """Every value within ``radius`` bits of a fingerprint, with the least fingerprint that
    this batch has near it. Rows leave in slices, so memory stays bounded."""
    flips = np.array(
        [sum(1 << i for i in chosen) for r in range(radius + 1) for chosen in combinations(range(64), r)], np.uint64
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 256):
                own = fps[at : at + 256]
                points, values = (own[:, None] ^ flips).ravel(), np.repeat(own, len(flips))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(points.view(np.int64)), pa.array(values.view(np.int64))], names=["point", "fp"]
                )

    return run


def link_fingerprints(
    distinct: DataFrame, max_bits: int = 4, blocks: int = 6, max_bucket: int = 20_000
) -> DataFrame:
    """Links ``a``, ``b`` that join exactly the distinct fingerprints (``fp``) whose
    chains of links of at most ``max_bits`` differing bits join them. Midpoints need an even
    ``max_bits``, so an odd one is refused whatever the data."""
    if max_bits % 2 or not 0 <= max_bits < blocks:
        raise ValueError("max_bits is even and less than blocks")
    dealt = distinct.select(F.explode(block_keys(F.col("fp"), blocks, max_bits)).alias("k"), "fp").select("k.*", "fp")
    sizes = dealt.groupBy("which", "part").count()
    crowded = cut(sizes.filter(F.col("count") > max_bucket).select("which", "part"), "crowded")
    if crowded.isEmpty():
        near = dealt
    else:
        near = dealt.join(crowded, ["which", "part"], "left_anti")
    links = (
        near.repartition("which", "part")
        .sortWithinPartitions("which", "part")
        .mapInArrow(_links_of_buckets(max_bits), "a long, b long")
    )
    if crowded.isEmpty():
        return links
    hot = dealt.join(crowded, ["which", "part"], "left_semi").select("fp").distinct()
    points = hot.repartition("fp").mapInArrow(_midpoint_stars(max_bits // 2), "point long, fp long")
    centres = points.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    stars = points.join(centres.select("point", "a"), "point").filter("a <> fp")
    return links.unionByName(stars.select("a", F.col("fp").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes with a link.

    Alternating star steps: every node is hung below the least of its neighbours, until
    nothing moves. A hub's neighbours are never gathered: each step is a minimum by key
    and a join, and every step starts from files.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
        "links",
    )
    while True:
        # Large star: neighbours greater than a node go below the node's least neighbour.
        around = both(edges)
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's lesser neighbours and the node go below the least of them.
        lesser = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lesser, "a")
        small = (
            moved.filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lesser.select("a", F.col("m").alias("b")))
            .distinct()
        )
        following = cut(small, "links")
        if _same(edges, following):
            return following.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = following


def _same(x: DataFrame, y: DataFrame) -> bool:
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return mark(x) == mark(y)


def _grouped(
    docs: DataFrame,
    text_col: str = "text",
    max_bits: int = 4,
    blocks: int = 6,
    shingle_words: int = 4,
    max_bucket: int = 20_000,
) -> tuple[DataFrame, DataFrame]:
    """``doc_id`` and ``fp`` of each row; ``fp``, ``root`` and ``component_id`` of each fingerprint."""
    marked = cut(fingerprints(docs, text_col, shingle_words), "fingerprints")
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(link_fingerprints(distinct.select("fp"), max_bits, blocks, max_bucket))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked, cut(rooted.join(named, "root").select("fp", "root", "component_id"), "classes")


@set_aside
def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``fp`` (signed long), ``fingerprint`` (16 hex digits), ``component_id``.

    Options are those of ``_grouped``: ``text_col``, ``max_bits``, ``blocks``,
    ``shingle_words`` and ``max_bucket``.
    """
    marked, classes = _grouped(docs, **options)
    return marked.join(classes, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@set_aside
def drop_near_duplicates(docs: DataFrame, text_col: str = "text", shingle_words: int = 4, **options) -> DataFrame:
    """One document of each group stays: the one of the smallest doc_id, or of none if no
    document of the group has one; of several such rows the least by all columns as text.
    """
    marked, classes = _grouped(docs, text_col=text_col, shingle_words=shingle_words, **options)
    stays = F.bool_or(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    ids = marked.filter("doc_id is not null").join(classes, "fp").groupBy(F.col("doc_id").alias("_id")).agg(
        stays.alias("_stays"), F.count("*").alias("_rows")
    )
    # Few documents go and fewer are repeated, so the texts are held against those ids.
    changed = cut(ids.filter(~F.col("_stays") | (F.col("_rows") > 1)), "marked")
    same = F.col("doc_id") == F.col("_id")
    once = docs.filter("doc_id is not null").join(changed, same, "left_anti")
    # An id of several rows, or none, does not tell which group a row is of; its text does.
    repeated = cut(changed.filter("_stays"), "repeated")
    unclear = []
    if not repeated.isEmpty():
        unclear.append(docs.join(repeated, same, "left_semi"))
    if not classes.filter("component_id is null").isEmpty():
        unclear.append(docs.filter("doc_id is null"))
    for some in unclear:
        found = _with_fingerprints(some, text_col, shingle_words).join(classes, "fp")
        heads = found.filter(F.col("row.doc_id").eqNullSafe(F.col("component_id")))
        again = heads.groupBy("root").agg(F.min_by("row", F.to_json("row")).alias("row"))
        once = once.unionByName(again.select("row.*"))
    return once


def _with_fingerprints(docs: DataFrame, text_col: str, shingle_words: int) -> DataFrame:
    """``row``, all columns of a document, and ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle_words) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["row", "fp"])

    chosen = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, T.StructType([chosen.schema["row"], T.StructField("fp", T.LongType())]))
