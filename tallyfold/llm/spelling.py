"""Spelling variants: words one edit apart, found through Bloom filters.

Two words are near if one inserted, deleted or replaced code point turns one into the
other. The vocabulary is put into blocked Bloom filters, one per word length: a word sets
five bits in one 64-bit block. The filters are broadcast. Every word generates its edits
as hashes, not as strings: a word's hash is the sum of one number per place and code point,
so a deletion or replacement is two table lookups away. Deletions are probed against the
filter one shorter, replacements by a greater code point against the word's own; that meets
every near pair once, since an insertion is a deletion seen from the other word. Only edits
a filter lets through become strings; they are shuffled to an exact join with the
vocabulary, which removes the false ones.

A filter takes ``bits`` per word. Those that fit ``max_filter_bytes`` together are
broadcast at once; a larger vocabulary has its filters cut by block into several parts,
each with a pass of its own, in which only edits of that part's blocks are probed.

A word has at most as many near words as edits, so nothing grows with a hot word: its
occurrences are counted before any shuffle, and a chain of forms has at most 19 steps, as
counts grow tenfold with each.

Defined results: null and empty words are left out; a repeated word's counts add up; an empty
vocabulary gives no rows; of near words with the same count the least in code-point order
is the form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import cut

SLICE_BLOCKS = 1 << 14  # by default so many blocks of a filter are built in one task: 128 KB
_CELLS = 1 << 21  # edits in hand at once

_U = np.uint64


def _numbers(places: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A number for each place and code point."""
    with np.errstate(over="ignore"):
        x = places.astype(_U) * _U(0x9E3779B97F4A7C15) + (codes.astype(_U) + _U(1)) * _U(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def codes_of(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _numbers(np.arange(codes.shape[1]), codes).sum(1, dtype=_U)


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((hashes >> _U(32)) * _U(blocks) >> _U(32)).astype(np.int64)


def mask_of(hashes: np.ndarray) -> np.ndarray:
    """Five bits of 64, from the lower 30 bits of the hash."""
    mask = np.zeros(len(hashes), _U) if hashes.ndim == 1 else np.zeros(hashes.shape, _U)
    for k in range(5):
        mask |= _U(1) << ((hashes >> _U(6 * k)) & _U(63))
    return mask


class Filters:
    """Blocks of the filters by word length; of a part of a filter, only the blocks it has."""

    def __init__(self, blocks: dict[int, int], slices: dict[tuple[int, int], bytes], slice_blocks: int = SLICE_BLOCKS):
        self.blocks = blocks
        self.held, self.first = {}, {}
        for length in {of for of, _ in slices}:
            own = sorted(i for of, i in slices if of == length)
            self.first[length] = own[0] * slice_blocks
            size = min(blocks[length], (own[-1] + 1) * slice_blocks) - self.first[length]
            self.held[length] = np.zeros(size, _U)
            for i in own:
                data = np.frombuffer(slices[length, i], _U)
                at = i * slice_blocks - self.first[length]
                self.held[length][at : at + len(data)] = data

    def might_have(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """False where no word of that length in this part has the hash."""
        if length not in self.held:
            return np.zeros(hashes.shape, bool)
        at = block_of(hashes, self.blocks[length]) - self.first[length]
        held = self.held[length]
        inside = (at >= 0) & (at < len(held))
        mask = mask_of(hashes)
        return inside & ((held[np.where(inside, at, 0)] & mask) == mask)


def possible_edits(words: list[str], length: int, filters: Filters, letters: np.ndarray) -> Iterator[tuple[int, str]]:
    """Number of the word, and an edit of it that a filter lets through."""
    step = max(1, _CELLS // (length * max(1, len(letters))))
    for begin in range(0, len(words), step):
        some = words[begin : begin + step]
        codes = codes_of(some, length)
        places = np.arange(length)
        with np.errstate(over="ignore"):
            own = _numbers(places, codes)
            if length > 1:
                shifted = _numbers(places - 1, codes)
                before = np.cumsum(own, 1, dtype=_U) - own
                after = np.cumsum(shifted[:, ::-1], 1, dtype=_U)[:, ::-1] - shifted
                found = filters.might_have(length - 1, before + after)
                # Of a run of equal letters only the last is taken out: the others give the same.
                found[:, :-1] &= codes[:, :-1] != codes[:, 1:]
                for i, p in zip(*(x.tolist() for x in np.nonzero(found)), strict=True):
                    yield begin + i, some[i][:p] + some[i][p + 1 :]
            total = own.sum(1, dtype=_U)
            wide = max(1, _CELLS // max(1, len(some)))
            for low in range(0, len(letters), wide):
                tried = letters[low : low + wide]
                for p in range(length):
                    edits = (total - own[:, p])[:, None] + _numbers(np.array([p]), tried)[None, :]
                    found = filters.might_have(length, edits) & (tried[None, :] > codes[:, p][:, None])
                    for i, c in zip(*(x.tolist() for x in np.nonzero(found)), strict=True):
                        yield begin + i, some[i][:p] + chr(int(tried[c])) + some[i][p + 1 :]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[int], list[str]]]:
    words = batch.column("word").to_pylist()
    of: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        of.setdefault(len(word), []).append(i)
    for length, at in of.items():
        if length:
            yield length, at, [words[i] for i in at]


def filter_slices(vocabulary: DataFrame, blocks: dict[int, int], slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """``length``, ``slice`` and the ``data`` of each slice of the filters."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, words in _by_length(batch):
                for at in range(0, len(words), max(1, _CELLS // length)):
                    hashes = word_hashes(codes_of(words[at : at + max(1, _CELLS // length)], length))
                    found = block_of(hashes, blocks[length])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), length, np.int32)), pa.array(found), pa.array(mask_of(hashes).view(np.int64))],
                        names=["length", "block", "mask"],
                    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        length, part = int(rows["length"].iloc[0]), int(rows["slice"].iloc[0])
        data = np.zeros(min(slice_blocks, blocks[length] - part * slice_blocks), np.int64)
        data[rows["block"].to_numpy() - part * slice_blocks] = rows["mask"].to_numpy()
        return pd.DataFrame({"length": [length], "slice": [part], "data": [data.tobytes()]})

    merged = vocabulary.select("word").mapInArrow(marks, "length int, block long, mask long").groupBy("length", "block")
    merged = merged.agg(F.bit_or("mask").alias("mask")).withColumn("slice", F.expr(f"cast(block div {slice_blocks} as int)"))
    return merged.groupBy("length", "slice").applyInPandas(build, "length int, slice int, data binary")


def near_pairs(
    vocabulary: DataFrame, bits: int = 32, max_filter_bytes: int = 64 << 20, slice_blocks: int = SLICE_BLOCKS
) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: every unordered pair of near words once, from distinct
    rows ``word``, ``n``."""
    session = vocabulary.sparkSession
    sizes = vocabulary.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    shapes = {r["length"]: r["n"] for r in sizes.collect() if r["length"]}
    blocks = {length: max(1, -(-n * bits // 64)) for length, n in shapes.items()}
    # Code points met in words of a length; a vocabulary has few.
    letters = F.explode(F.array_distinct(F.split("word", "")))
    met = vocabulary.select(F.length("word").alias("length"), letters.alias("letter")).filter("letter <> ''").distinct()
    alphabet: dict[int, np.ndarray] = {
        r["length"]: np.sort(np.array([ord(c) for c in r["letters"]], np.uint32))
        for r in met.groupBy("length").agg(F.collect_list("letter").alias("letters")).collect()
    }
    slices = cut(filter_slices(vocabulary, blocks, slice_blocks), "filter-slices")
    order = sorted((length, part) for length, n in blocks.items() for part in range(-(-n // slice_blocks)))
    held = max(1, max_filter_bytes // (8 * slice_blocks))
    found = None
    for begin in range(0, max(1, len(order)), held):
        own = order[begin : begin + held]
        if not own:
            break
        (first, low), (last, high) = own[0], own[-1]
        inside = F.struct("length", "slice").between(F.struct(F.lit(first), F.lit(low)), F.struct(F.lit(last), F.lit(high)))
        rows = slices.filter(inside).collect()  # at most ``max_filter_bytes``
        shared = session.sparkContext.broadcast((blocks, {(r["length"], r["slice"]): bytes(r["data"]) for r in rows}, slice_blocks))
        passed = vocabulary.mapInArrow(_probe(shared, alphabet), "edit string, word string, n long")
        found = passed if found is None else found.unionByName(passed)
    if found is None:
        return session.createDataFrame([], "a string, n_a long, b string, n_b long")
    exact = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    return found.join(exact, found["edit"] == exact["b"]).select(F.col("word").alias("a"), F.col("n").alias("n_a"), "b", "n_b")


def _probe(shared, alphabet: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(*shared.value)
        for batch in batches:
            counts = batch.column("n").to_pylist()
            edits, words, own = [], [], []
            for length, at, some in _by_length(batch):
                for i, edit in possible_edits(some, length, filters, alphabet[length]):
                    edits.append(edit)
                    words.append(some[i])
                    own.append(counts[at[i]])
                    if len(edits) == 1 << 16:
                        yield _edits(edits, words, own)
                        edits, words, own = [], [], []
            yield _edits(edits, words, own)

    return run


def _edits(edits: list[str], words: list[str], counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(edits, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["edit", "word", "n"]
    )


def group_variants(
    words: DataFrame, ratio: int = 10, bits: int = 32, max_filter_bytes: int = 64 << 20, slice_blocks: int = SLICE_BLOCKS
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` from rows ``word``, ``n``.

    A word's form is its near word of largest ``n``, if that is at least ``ratio`` times its
    own (``ratio`` of 2 or more); the root is where the chain of forms ends.
    """
    if ratio < 2:
        raise ValueError("forms may go in circles with a ratio below 2")
    counted = words.filter("word <> ''").groupBy("word").agg(F.sum(F.col("n").cast("long")).alias("n"))
    vocabulary = cut(counted, "vocabulary")
    pairs = cut(near_pairs(vocabulary, bits, max_filter_bytes, slice_blocks), "near-pairs")
    better = lambda name, n: F.struct((-F.col(n)).alias("less"), F.col(name).alias("other"))
    near = pairs.select(F.col("a").alias("word"), better("b", "n_b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), better("a", "n_a").alias("near"))
    )
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("best"))
    judged = vocabulary.join(best, "word", "left").withColumn("follows", -F.col("best.less") >= ratio * F.col("n"))
    judged = cut(
        judged.select(
            "word",
            F.when(F.col("follows"), F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("follows"), -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _chain_ends(judged.filter("form is not null").select("word", "form"))
    found = judged.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _chain_ends(links: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word of its chain of forms."""
    step = links.select(F.col("word").alias("at"), F.col("form").alias("following"))
    ended, open_ = None, links.select("word", F.col("form").alias("at"))
    while True:
        moved = cut(open_.join(step, "at", "left"), "chains")
        done = moved.filter("following is null").select("word", F.col("at").alias("root"))
        ended = done if ended is None else ended.unionByName(done)
        open_ = moved.filter("following is not null").select("word", F.col("following").alias("at"))
        if open_.isEmpty():
            return ended
