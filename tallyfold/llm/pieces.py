"""Encoding to pieces of a SentencePiece BPE model with seeded merge-dropout, and back.

Merges run from an agenda: the adjacent pair whose piece scores best comes first, the
leftmost of equals. Each candidate taken from the agenda is skipped if a hash of seed,
document, number of the chunk, place and piece falls below the dropout; a skipped candidate
is gone until a merge beside it makes a new one. A chunk is a run of spaces with the
characters up to the next space; no piece of such a model crosses that border (checked when
the model is read), so chunks can be encoded apart. Every occurrence of a word has draws of
its own. A task keeps the merges of a chunk without dropout: draws are held against those
candidates first, and only occurrences of which one is skipped run their agenda again.

Decoding gives back the text exactly: spaces are the only characters a piece writes
differently, one space is put before a text and taken off again, and characters outside
the vocabulary (a literal U+2581 among them) become byte pieces.

Defined results: a null or empty text has no pieces, and no pieces decode to an empty
text; a null doc_id counts as the empty string; repeated rows are encoded alike unless an
``occurrence`` tells them apart. The input's columns travel in one struct and cannot clash;
``pieces`` and ``decoded`` replace input columns of the same name.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.llm.common import set_aside

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_BITS = (1 << 64) - 1
_KEPT_CUTS = 200_000  # chunks whose merges a task keeps
_WIDEST = 24  # characters of chunks that are cut many at a time
_BLOCK = 1 << 19


class PieceModel:
    """Vocabulary of a BPE model with byte fallback; spaces stand for the space mark."""

    def __init__(self, proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = range(model.get_piece_size())
        byte = {i for i in ids if model.is_byte(i)}
        normal = [i for i in ids if not (i in byte or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        pieces = {i: model.id_to_piece(i).replace("▁", " ") for i in normal}
        if any(re.search("[^ ] ", piece) for piece in pieces.values()) or len(byte) != 256:
            raise ValueError("the model's pieces cross word borders, or it has no byte fallback")
        self.ids = {piece: i for i, piece in pieces.items()}
        self.order = {i: -model.get_score(i) for i in normal}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in byte}
        self.surface = [b""] * len(ids)
        for i, piece in pieces.items():
            self.surface[i] = piece.encode()
        for value, i in self.bytes.items():
            self.surface[i] = bytes([value])
        self._tables(pieces)
        alone = "" if any("\n" in piece for piece in pieces.values()) else r"\n"
        self.chunks = re.compile(rf" *[^ {alone}]+|{alone or '(?!)'}| +")

    def _tables(self, pieces: dict[int, str]) -> None:
        """The vocabulary as arrays: symbols are pieces, numbered from 0 in order of id."""
        self.symbol_ids = np.array(list(pieces), np.int32)
        number = {piece: i for i, piece in enumerate(pieces.values())}
        _, self.ranks = np.unique([self.order[i] for i in pieces], return_inverse=True)
        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, i in number.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        made = {}
        for piece, i in number.items():
            for at in range(1, len(piece)):
                left, right = number.get(piece[:at]), number.get(piece[at:])
                if left is not None and right is not None:
                    made[left * len(number) + right] = i
        self._index(np.array(list(made), np.int64), np.array(list(made.values()), np.int32))

    def _index(self, pairs: np.ndarray, made: np.ndarray) -> None:
        """Pairs of symbols in a table of open addresses, at most an eighth full."""
        bits = max(4, (8 * len(pairs)).bit_length())
        self.shift, self.pairs, self.made = np.uint64(64 - bits), np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at = self._address(pairs)
        left = np.arange(len(pairs))
        while len(left):
            free = self.pairs[at[left]] < 0
            first = left[free][np.unique(at[left[free]], return_index=True)[1]]
            self.pairs[at[first]], self.made[at[first]] = pairs[first], made[first]
            left = np.setdiff1d(left, first, assume_unique=True)
            at[left] += self.pairs[at[left]] >= 0
            at[left] &= len(self.pairs) - 1

    def _address(self, pairs: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def cut_many(self, chunks: list[str], keys: np.ndarray, limit: int = 0, taken: list | None = None) -> list[bytes]:
        """``cut`` of many chunks at once, each with its key, as bytes of 32-bit ids.
        ``taken`` gets arrays of chunk number, place and piece of the candidates met.

        A round takes the best candidate of every chunk's agenda: the pair of least rank,
        the leftmost of equals. Chunks that are long or need byte pieces are cut singly.
        """
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        found = [b""] * len(chunks)
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        symbols = self.of_char[codes]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        unknown = np.concatenate(([0], np.cumsum(symbols < 0)))
        easy = (sizes <= _WIDEST) & (unknown[starts[1:]] == unknown[starts[:-1]]) & (sizes > 0)
        if taken is not None:
            taken.append(easy)
        for i in np.flatnonzero(~easy).tolist():
            found[i] = np.array(self.cut(chunks[i], int(keys[i]), limit), np.int32).tobytes()
        for low, high in ((0, 6), (6, 12), (12, _WIDEST)):  # little padding
            rows = np.flatnonzero(easy & (sizes > low) & (sizes <= high))
            for at in range(0, len(rows), 1 << 16):
                part = rows[at : at + (1 << 16)]
                flat, ends = self._cut_rows(symbols, starts[part], sizes[part], keys[part], limit, part, taken)
                data, begin = flat.tobytes(), 0
                for i, end in zip(part.tolist(), (4 * ends).tolist(), strict=True):
                    found[i] = data[begin:end]
                    begin = end
        return found

    def _cut_rows(self, symbols, starts, sizes, keys, limit, numbers, taken) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(starts), int(sizes.max())
        columns = np.arange(width)
        inside = columns < sizes[:, None]
        # One column more than the widest chunk: where the last part's successor points.
        held = np.full((n, width + 1), -1, np.int32)
        held[:, :-1][inside] = symbols[(starts[:, None] + columns)[inside]]
        after = np.tile(np.arange(1, width + 2, dtype=np.int16), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int16), (n, 1))
        none = np.iinfo(np.int32).max
        rank, merged = np.full((n, width), none, np.int32), np.full((n, width), -1, np.int32)
        made, ranks = self._made(held[:, :-1].ravel(), held[:, 1:].ravel())
        merged[:], rank[:] = made.reshape(n, width), ranks.reshape(n, width)
        rows = np.arange(n)
        while len(rows):
            left = rank[rows].argmin(1)
            open_ = rank[rows, left] < none
            rows, left = rows[open_], left[open_]
            if not len(rows):
                break
            piece = merged[rows, left]
            rank[rows, left] = none
            if taken is not None:
                taken.append((numbers[rows], left.astype(np.int32), self.symbol_ids[piece]))
            if limit:
                kept = _draws(keys[rows], left, self.symbol_ids[piece]) >= np.uint64(limit) if limit < 1 << 64 else np.zeros(len(rows), bool)
                at, left, piece = rows[kept], left[kept], piece[kept]
            else:
                at = rows
            right = after[at, left].astype(np.int64)
            nxt = after[at, right].astype(np.int64)
            held[at, left], held[at, right] = piece, -1
            rank[at, right] = none
            after[at, left] = nxt
            last = nxt >= width
            before[at[~last], nxt[~last]] = left[~last]
            merged[at, left], rank[at, left] = self._made(piece, held[at, nxt])
            prev = before[at, left].astype(np.int64)
            has = prev >= 0
            at, prev, piece = at[has], prev[has], piece[has]
            merged[at, prev], rank[at, prev] = self._made(held[at, prev], piece)
        alive = held[:, :-1] >= 0
        return self.symbol_ids[held[:, :-1][alive]], np.cumsum(alive.sum(1))

    def _made(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and rank of the piece two symbols make, or -1 and the greatest number."""
        key = left.astype(np.int64) * len(self.symbol_ids) + right
        at = self._address(key)
        met = self.pairs[at]
        other = np.flatnonzero((met != key) & (met >= 0))
        while len(other):
            at[other] = (at[other] + 1) & (len(self.pairs) - 1)
            met[other] = self.pairs[at[other]]
            other = other[(met[other] != key[other]) & (met[other] >= 0)]
        good = (met == key) & (left >= 0) & (right >= 0)
        symbol = np.where(good, self.made[at], -1)
        return symbol, np.where(good, self.ranks[symbol], np.iinfo(np.int32).max)

    def cut(self, chunk: str, key: int = 0, limit: int = 0) -> list[int]:
        """Piece ids of one chunk; candidates whose hash with ``key`` is below ``limit`` are skipped."""
        ids, order = self.ids, self.order
        parts: list[str] = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            piece = parts[left] + parts[right]
            found = ids.get(piece)
            if found is not None:
                agenda.append((order[found], left, right, piece))

        for i in range(n - 1):
            offer(i, i + 1)
        heapq.heapify(agenda)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            if not parts[left] or not parts[right] or len(parts[left]) + len(parts[right]) != len(piece):
                continue
            if limit and _draw(key, left, ids[piece]) < limit:
                continue
            parts[left], parts[right] = piece, ""
            nxt = after[right]
            after[left] = nxt
            if nxt < n:
                before[nxt] = left
            size = len(agenda)
            if before[left] >= 0:
                offer(before[left], left)
            if nxt < n:
                offer(left, nxt)
            for at in range(size, len(agenda)):
                heapq._siftdown(agenda, 0, at)
        out = []
        for part in parts:
            if part:
                found = ids.get(part)
                out += [found] if found is not None else [self.bytes[b] for b in part.encode()]
        return out

    def decode(self, pieces: Iterable[int]) -> str:
        surface = self.surface
        return b"".join([surface[i] for i in pieces])[1:].decode()

    def decode_many(self, pieces: np.ndarray, ends: list[int]) -> list[str]:
        """Texts of pieces that stand one after another, each up to its end."""
        said, out, begin = list(map(self.surface.__getitem__, pieces.tolist())), [], 0
        for end in ends:
            out.append(b"".join(said[begin:end])[1:].decode())
            begin = end
        return out


def _draw(key: int, left: int, piece: int) -> int:
    x = (key ^ (left * 0x9E3779B97F4A7C15) ^ (piece * 0xC2B2AE3D27D4EB4F)) & _BITS
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _BITS
    x = ((x ^ (x >> 29)) * 0x94D049BB133111EB) & _BITS
    return x ^ (x >> 32)


def _draws(keys: np.ndarray, left: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """``_draw`` of many."""
    with np.errstate(over="ignore"):
        x = keys ^ (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (piece.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


class Encoder:
    """Encodes texts with one seed; keeps the merges of chunks up to a bound."""

    def __init__(self, model: PieceModel, dropout: float, seed: int):
        self.model, self.seed = model, seed
        self.limit = int(dropout * (1 << 64))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.cuts: list[bytes] = []
        # Candidates of chunk i: from ends[i - 1] to ends[i]; -1 for chunks that are cut each time.
        self.ends, self.sure = np.zeros(1, np.int64), np.zeros(0, bool)
        self.left, self.piece = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def keys_of(self, doc_key: str, first: int, n: int) -> np.ndarray:
        """Keys of a document's chunks from number ``first``."""
        with np.errstate(over="ignore"):
            x = np.uint64(xxhash.xxh64_intdigest(doc_key, self.seed & _BITS)) ^ (np.arange(first, first + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            return x ^ (x >> np.uint64(32))

    def _learn(self, chunks: list[str]) -> None:
        """Merges without dropout of chunks not met before."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if len(self.known) + len(new) > _KEPT_CUTS:
            self._forget()
            new = list(dict.fromkeys(chunks))
        if not new:
            return
        taken: list = []
        cuts = self.model.cut_many(new, np.zeros(len(new), np.uint64), 0, taken)
        easy, met = taken[0], taken[1:]
        number, left, piece = (np.concatenate([m[k] for m in met]) if met else np.zeros(0, np.int64) for k in range(3))
        order = np.argsort(number, kind="stable")
        self.left = np.concatenate([self.left, left[order].astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece[order].astype(np.int32)])
        counts = np.bincount(number.astype(np.int64), minlength=len(new))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.sure = np.concatenate([self.sure, easy])
        self.known.update(zip(new, range(len(self.cuts), len(self.cuts) + len(new)), strict=True))
        self.cuts += cuts

    def _cut_all(self, chunks: list[str], keys: np.ndarray) -> list[bytes]:
        """Cuts of all occurrences, each with its own key."""
        self._learn(chunks)
        known, cuts = self.known, self.cuts
        at = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        found = [cuts[i] for i in at.tolist()]
        if not self.limit:
            return found
        counts = self.ends[at + 1] - self.ends[at]
        before = np.concatenate(([0], np.cumsum(counts)))
        spot = np.arange(before[-1]) + np.repeat(self.ends[at] - before[:-1], counts)
        skipped = np.ones(len(spot), bool)
        if self.limit < 1 << 64:
            skipped = _draws(np.repeat(keys, counts), self.left[spot].astype(np.int64), self.piece[spot]) < np.uint64(self.limit)
        so_far = np.concatenate(([0], np.cumsum(skipped)))
        again = np.flatnonzero((so_far[before[1:]] > so_far[before[:-1]]) | ~self.sure[at])
        for i, cut in zip(again.tolist(), self.model.cut_many([chunks[i] for i in again.tolist()], keys[again], self.limit), strict=True):
            found[i] = cut
        return found

    def encode_many(self, texts: Iterable[str], doc_keys: Iterable[str]) -> tuple[bytearray, list[int]]:
        """Piece ids of all texts one after another, as bytes, and how many end each text. Chunks are
        cut about half a million characters at a time; longer texts are walked block by block."""
        out, ends, chunks, keys, marks, size = bytearray(), [], [], [], [], 0

        def flush() -> None:
            nonlocal size
            cuts = self._cut_all(chunks, np.concatenate(keys)) if chunks else []
            begin = 0
            for mark in marks:
                out.extend(b"".join(cuts[begin:mark]))
                ends.append(len(out) // 4)
                begin = mark
            out.extend(b"".join(cuts[begin:]))
            chunks.clear(), keys.clear(), marks.clear()
            size = 0

        for text, doc_key in zip(texts, doc_keys, strict=True):
            text, n, at = (" " + text if text else ""), 0, 0
            while at < len(text):
                end = len(text) if len(text) - at <= _BLOCK else self._border(text, at + _BLOCK)
                own = self.model.chunks.findall(text, at, end)
                chunks += own
                keys.append(self.keys_of(doc_key, n, len(own)))
                n, size, at = n + len(own), size + end - at, end
                if size >= _BLOCK:
                    flush()
            marks.append(len(chunks))
        flush()
        return out, ends

    def encode(self, text: str, doc_key: str) -> list[int]:
        return np.frombuffer(self.encode_many([text], [doc_key])[0], np.int32).tolist()

    @staticmethod
    def _border(text: str, at: int) -> int:
        """The next place where a run of spaces begins."""
        found = re.compile("(?<! ) ").search(text, at)
        return found.start() if found else len(text)


@functools.lru_cache(maxsize=2)
def _model(proto: bytes) -> PieceModel:
    return PieceModel(proto)


def read_model(path: str = MODEL) -> bytes:
    """The model file, read on the driver and sent along with the job (half a megabyte)."""
    with open(path, "rb") as file:
        return file.read()


@set_aside
def encode(
    docs: DataFrame,
    proto: bytes,
    dropout: float = 0.1,
    seed: int = 7,
    text_col: str = "text",
    id_col: str = "doc_id",
    occurrence: Column | None = None,
    check: bool = False,
) -> DataFrame:
    """``docs`` with ``pieces`` (array of ids) for the text; with ``check`` also ``decoded``,
    the text of those pieces, made in the same pass. Rows of one id are drawn apart by
    ``occurrence``, such as an epoch."""
    added = ["pieces", "decoded"] if check else ["pieces"]
    own = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        encoder = Encoder(model, dropout, seed)
        for batch in batches:
            rows, texts, keys, at = batch.column(0), batch.column(1), batch.column(2), 0
            while at < batch.num_rows:
                first, size = at, 0
                while at < batch.num_rows and size < 1 << 21:
                    size, at = size + len(texts[at].as_buffer() or b""), at + 1
                part = slice(first, at)
                ids, ends = encoder.encode_many(texts[part].to_pylist(), keys[part].to_pylist())
                values = np.frombuffer(ids, np.int32)
                columns = [rows[part], pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(values))]
                if check:
                    columns.append(pa.array(model.decode_many(values, ends), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["row", *added])

    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    if occurrence is not None:
        key = F.concat_ws("#", key, occurrence.cast("string"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    fed = docs.select(F.struct(*own).alias("row"), text.alias("text"), key.alias("key"))
    schema = T.StructType([fed.schema["row"], *[_ADDED[c] for c in added]])
    return fed.mapInArrow(run, schema).select("row.*", *added)


_ADDED = {"pieces": T.StructField("pieces", T.ArrayType(T.IntegerType())), "decoded": T.StructField("decoded", T.StringType())}


@set_aside
def decode(encoded: DataFrame, proto: bytes, pieces_col: str = "pieces") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its pieces."""
    own = [c for c in encoded.columns if c != "decoded"]
    shared = encoded.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [model.decode(x.values.to_pylist()) if x.is_valid else "" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "decoded"])

    fed = encoded.select(F.struct(*own).alias("row"), F.col(pieces_col).alias("pieces"))
    return fed.mapInArrow(run, T.StructType([fed.schema["row"], _ADDED["decoded"]])).select("row.*", "decoded")
