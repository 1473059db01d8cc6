"""Repeated lines, found by probing a sharded minimal perfect hash.

Distinct line keys are counted by their hashes (two of 64 bits, so 128 together). Those in
enough documents go into an index of shards; each shard is a minimal perfect hash, and its
slot of a key holds a fingerprint, the number of documents, and the last of them. Documents
send the hashes of their lines to the shard that may hold them; no line text moves. A task
holds one shard and one batch of probes. Probes of a shard are dealt over ``salts`` tasks,
each with a copy of the shard's arrays (some 20 bytes a line), and a document sends a
repeated key once, so a line of a third of all documents is 32 streams, not one.

Defined results: a null text is one empty line and becomes an empty text; a row is a
document, so a repeated row counts again; rows that share the largest doc_id all keep
their lines; a null doc_id ranks below all others; no rows give no rows. Columns
``n_lines`` and ``n_dropped`` replace input columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import SPACE_BYTES, cut, set_aside

NO_ID = -(1 << 63)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, ASCII letters lower-cased."""
    return line.strip(SPACE_BYTES).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    """Counts code points; bytes decide where they can."""
    return len(key) >= 4 * min_chars or (len(key) >= min_chars and len(key.decode()) >= min_chars)


def key_hashes(key: bytes) -> tuple[int, int]:
    return xxhash.xxh64_intdigest(key, 0), xxhash.xxh64_intdigest(key, 1)


def _mixed(h: np.ndarray, fp: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h ^ (fp * _GOLDEN) ^ (np.uint64(level + 1) * np.uint64(0xD1B54A32D192ED03))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash: each level keeps the keys that fall alone on a bit, and the
    others go on to the next. A key's slot is the number of set bits before its own."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.before = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @classmethod
    def build(cls, h: np.ndarray, fp: np.ndarray, spread: float = 2.0) -> PerfectHash:
        sizes, levels = [], []
        while len(h):
            size = max(64, int(spread * len(h)))
            at = (_mixed(h, fp, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            stay = ~alone[at]
            h, fp = h[stay], fp[stay]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, h: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that is not held gets some slot or -1."""
        found = np.full(len(h), -1, np.int64)
        open_, start = np.arange(len(h)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (_mixed(h[open_], fp[open_], level) % np.uint64(size)).astype(np.int64) + start
            hit = self.bits[at]
            found[open_[hit]] = self.before[at[hit]]
            open_ = open_[~hit]
            start += size
        return found


class Shard:
    """Arrays by slot: fingerprint, count of documents, last document."""

    def __init__(self, hashed: PerfectHash, fp: np.ndarray, count: np.ndarray, last: np.ndarray):
        self.hashed, self.fp, self.count, self.last = hashed, fp, count, last

    @classmethod
    def build(cls, h: np.ndarray, fp: np.ndarray, count: np.ndarray, last: np.ndarray) -> Shard:
        hashed = PerfectHash.build(h, fp)
        order = np.empty(len(h), np.int64)
        order[hashed.slots(h, fp)] = np.arange(len(h))
        return cls(hashed, fp[order], count[order].astype(np.uint32), last[order])

    def dump(self) -> bytes:
        head = np.array([len(self.hashed.sizes), len(self.fp), *self.hashed.sizes], np.int64)
        bits = np.packbits(self.hashed.bits)
        return b"".join(x.tobytes() for x in (head, self.fp, self.last, self.count, bits))

    @classmethod
    def load(cls, data: bytes) -> Shard:
        levels, n = np.frombuffer(data, np.int64, 2)
        sizes = np.frombuffer(data, np.int64, levels, 16).tolist()
        at = 16 + 8 * int(levels)
        fp = np.frombuffer(data, np.uint64, n, at)
        last = np.frombuffer(data, np.int64, n, at + 8 * int(n))
        count = np.frombuffer(data, np.uint32, n, at + 16 * int(n))
        bits = np.frombuffer(data, np.uint8, -1, at + 20 * int(n))
        return cls(PerfectHash(sizes, np.unpackbits(bits, count=sum(sizes)).astype(bool)), fp, count, last)

    def probe(self, h: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """Slot of each key that is held, else -1."""
        slots = self.hashed.slots(h, fp)
        held = slots >= 0
        held[held] = self.fp[slots[held]] == fp[held]
        return np.where(held, slots, -1)


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``h``, ``fp``, ``doc_id``, ``text_hash``: each distinct key of a document once.

    The way back to a document goes by its id and text, so rows without an id, or of the
    same id, do not meet in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owners, texts = [], [], []
            for doc_id, text, text_hash in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = (text.as_py() or "").encode()
                keys = {k for line in data.split(b"\n") if long_enough(k := line_key(line), min_chars)}
                hashes += [key_hashes(k) for k in keys]
                owners += [NO_ID if doc_id is None else doc_id] * len(keys)
                texts += [text_hash] * len(keys)
            pairs = np.array(hashes, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(owners, pa.int64()), pa.array(texts, pa.int64())],
                names=["h", "fp", "doc_id", "text_hash"],
            )

    own = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return own.mapInArrow(run, "h long, fp long, doc_id long, text_hash long")


def build_index(repeated: DataFrame, keys_per_shard: int) -> tuple[DataFrame, int]:
    """One row per shard (``shard``, ``data``) from rows ``h``, ``fp``, ``n``, ``last``."""
    shards = math.ceil(repeated.count() / keys_per_shard)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        h, fp = (rows[c].to_numpy().view(np.uint64) for c in ("h", "fp"))
        data = Shard.build(h, fp, rows["n"].to_numpy(), rows["last"].to_numpy()).dump()
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "data": [data]})

    placed = repeated.withColumn("shard", F.expr(f"cast(pmod(h, {max(shards, 1)}) as int)"))
    return placed.groupBy("shard").applyInPandas(build, "shard int, data binary"), shards


def probe_index(lines: DataFrame, index: DataFrame, shards: int, salts: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``h`` of each line that its document loses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = None, None
        for batch in batches:
            place, h, fp, owner, texts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            data = batch.column(5)
            cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(place) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if data[a].is_valid:
                    shard, at, a = Shard.load(data[a].as_py()), place[a], a + 1
                if at != place[min(a, b - 1)] or a == b:
                    continue
                slots = shard.probe(h[a:b].view(np.uint64), fp[a:b].view(np.uint64))
                lost = (slots >= 0) & (shard.last[slots] != owner[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column[a:b][lost]) for column in (owner, texts, h)], names=["doc_id", "text_hash", "h"]
                )

    salt = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(salts)) if salts > 1 else F.lit(0)
    probes = lines.select(
        (F.expr(f"pmod(h, {shards})") * salts + salt).cast("int").alias("place"), "h", "fp", "doc_id", "text_hash",
        F.lit(None).cast("binary").alias("data"),
    )
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    held = index.select("shard", "data", spread.alias("salt")).select(
        (F.col("shard") * salts + F.col("salt")).cast("int").alias("place"),
        *[F.lit(0).cast("long").alias(c) for c in ("h", "fp", "doc_id", "text_hash")], "data",
    )
    return (
        probes.unionByName(held)
        .repartition("place")
        .sortWithinPartitions("place", F.col("data").isNull())
        .mapInArrow(run, "doc_id long, text_hash long, h long")
    )


def _rewritten(columns: list[str], min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, dropped = [], [], []
            for text, lost in zip(batch.column("text"), batch.column("_lost").to_pylist(), strict=True):
                text = text.as_py() or ""
                lines = text.split("\n")
                totals.append(len(lines))
                if lost:
                    gone = {x & 0xFFFFFFFFFFFFFFFF for x in lost}
                    kept = []
                    for line in lines:
                        key = line_key(line.encode())
                        if not (long_enough(key, min_chars) and xxhash.xxh64_intdigest(key, 0) in gone):
                            kept.append(line)
                    text, lines = "\n".join(kept), kept
                dropped.append(totals[-1] - len(lines))
                texts.append(text)
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            arrays += [pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n_lines", "n_dropped"])

    return run


@set_aside
def drop_repeated_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    keys_per_shard: int = 1 << 16,
    salts: int = 32,
) -> DataFrame:
    """``docs`` without the lines whose key is in at least ``min_docs`` documents, except
    in the largest doc_id holding it; adds ``n_lines`` (before) and ``n_dropped``."""
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    docs = docs.select(*own)
    lines = hashed_lines(docs, min_chars)
    repeated = cut(
        lines.groupBy("h", "fp").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).filter(F.col("n") >= min_docs),
        "repeated-lines",
    )
    index, shards = build_index(repeated, keys_per_shard)
    if shards:
        lost = probe_index(lines, index, shards, salts).groupBy("doc_id", "text_hash").agg(F.collect_set("h").alias("_lost"))
        lost = lost.withColumnsRenamed({"doc_id": "_owner", "text_hash": "_hash"})
        mine = (F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == F.col("_owner")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
        joined = docs.join(lost, mine, "left").drop("_owner", "_hash")
    else:
        joined = docs.withColumn("_lost", F.lit(None).cast("array<long>"))
    schema = ", ".join(
        [*(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema), "n_lines long", "n_dropped long"]
    )
    return joined.mapInArrow(_rewritten(own, min_chars), schema)
