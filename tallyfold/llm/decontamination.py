"""Benchmark decontamination by a broadcast set of test word windows.

Words are runs of digits, letters a-z and everything beyond ASCII, after lower-casing A-Z.
Every run of ``window`` consecutive words of a test item is a window; an item of fewer
words is one window. The distinct windows are broadcast by their hashes. Documents are
scanned once, row by row: each of their windows is hashed and probed, a probe that hits is
verified by the words themselves, and only verified hits leave the scan, next to one row
per document. So what is shuffled grows with documents and hits, never with words.

The set is broadcast only up to ``max_windows`` windows. A larger one is broadcast in
parts of that size, one scan each, over documents numbered once in the shared folder.

Defined results: a null text, of a document or an item, has no words; a null item_id counts
as the empty string, and items of the same id are one item; repeated documents are judged
alike, each on its own row; empty tables are fine (no items: nothing is hit). Columns
``n_words``, ``n_hit``, ``spans`` and ``items`` replace input columns of the same name; all
other input columns travel in one struct and cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import LOWER, UPPER, cut, set_aside

# What lies between words of lower-cased texts; the same, and words, of texts as
# they are.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ADDED = ("n_words", "n_hit", "spans", "items")
_SALTS = 16


def normal_words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, BETWEEN), "")


def _window(at: Column, length: Column) -> Column:
    """The ``length`` words from place ``at``. Slices, hashes and joins of words are all
    compiled, unlike functions of lambdas."""
    return F.slice("words", at + 1, length)


def test_windows(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: ``h``, ``window`` (its words, space-joined), ``length``, ``items``.

    The item ids of a window are a list, so it grows with the number of test items.
    """
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), normal_words(F.col(text_col)).alias("words")
    )
    items = items.filter(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(window)))
    places = items.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))))
    said = _window(F.col("at"), F.col("length"))
    return (
        places.select("item", "length", F.xxhash64(said).alias("h"), F.array_join(said, " ").alias("window"))
        .groupBy("h", "window", "length")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


test_windows.__test__ = False  # not a test, whatever its name


def _verified_hits(words: DataFrame, windows: DataFrame, lengths: Sequence[int], keep_all: bool) -> DataFrame:
    """``row``, ``at``, ``length``, ``items_of`` of each verified hit; with ``keep_all`` also
    one row per document with ``own`` and ``n_words``."""
    counts = [F.greatest(F.col("n_words") - length + 1, F.lit(0)) for length in lengths]
    # Places of all windows of the first length, then of the next; with ``keep_all`` one more.
    total = sum(counts, F.lit(0))
    places = F.sequence(F.lit(0), total) if keep_all else F.sequence(F.lit(0), total - 1)
    probes = words if keep_all else words.filter(total > 0)
    probes = probes.select("row", "own", "words", "n_words", total.alias("total"), F.explode(places).alias("place"))
    at, length, before = F.col("place"), F.lit(0), F.lit(0)
    for size, n in zip(lengths, counts, strict=True):
        at = F.when(F.col("place") >= before, F.col("place") - before).otherwise(at)
        length = F.when(F.col("place") >= before, F.lit(size)).otherwise(length)
        before = before + n
    ends = F.col("place") == F.col("total")
    probes = probes.withColumns({"at": at, "length": length})
    probes = probes.withColumn("h", F.when(~ends, F.xxhash64(_window(F.col("at"), F.col("length")))))
    same = F.array_join(_window(F.col("at"), F.col("length")), " ") == F.col("window")
    found = probes.join(F.broadcast(windows.select("h", "window", "items_of")), "h", "left").filter(F.col("h").isNull() | same)
    ends = F.col("h").isNull()  # a document's own row
    return found.select(
        "row",
        F.when(ends, F.col("own")).alias("own"),
        F.when(ends, F.col("n_words")).alias("n_words"),
        F.when(~ends, F.struct("at", "length")).alias("hit"),
        "items_of",
    )


@set_aside
def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    max_windows: int = 1 << 19,
) -> DataFrame:
    """Columns ``carry`` of each document (all by default) with ``n_words``, ``n_hit`` (words
    inside a test window), ``spans`` (their maximal runs: first word and the one after the
    last) and ``items`` (ids of the test items of the windows, sorted as strings)."""
    carried = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    windows = cut(test_windows(benchmark, window), "test-windows")
    # Windows of the same items share the number of that list.
    lists = cut(windows.select("items").distinct().withColumn("items_of", F.monotonically_increasing_id()), "item-lists")
    windows = cut(windows.join(lists, "items").select("h", "window", "length", "items_of"), "numbered-windows")
    sizes = {r["length"]: r["n"] for r in windows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lengths, parts = sorted(sizes), max(1, -(-sum(sizes.values()) // max_windows))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*carried).alias("own"), F.col(text_col).alias("text")
    )
    if parts > 1:
        numbered = cut(numbered, "numbered")
    words = numbered.select("row", "own", normal_words(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    hits = _verified_hits(words, windows if parts == 1 else _part(windows, 0, parts), lengths, True)
    for part in range(1, parts):
        hits = hits.unionByName(_verified_hits(words, _part(windows, part, parts), lengths, False))
    by_row = hits.groupBy("row").agg(
        F.first("own", ignorenulls=True).alias("own"),
        F.max("n_words").alias("n_words"),
        F.collect_list("hit").alias("hits"),
        F.array_sort(F.collect_set("items_of")).alias("item_lists"),
    )
    places = F.flatten(F.transform("hits", lambda x: F.sequence(x["at"], x["at"] + x["length"] - 1)))
    found = cut(by_row.withColumn("places", F.array_sort(F.array_distinct(places))).drop("hits", "row"), "found")
    clean, hit = found.filter(F.size("places") == 0), found.filter(F.size("places") > 0)
    # Documents with the same item lists get their items once; a common answer is salted.
    combined = hit.select("item_lists").distinct()
    named = (
        combined.select("item_lists", F.explode("item_lists").alias("items_of"))
        .join(lists, "items_of")
        .select("item_lists", F.explode("items").alias("item"))
        .groupBy("item_lists")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    )
    salted = hit.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"))
    with_items = salted.join(named, ["item_lists", "salt"]).select("own", "n_words", "places", "items")
    whole = with_items.unionByName(clean.select("own", "n_words", "places", F.array().cast("array<string>").alias("items")))
    added = F.struct(
        F.col("n_words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_hit"),
        _runs("places").alias("spans"),
        "items",
    )
    # Two steps, so that no expression meets the input's columns.
    return whole.select("own", added.alias("added")).select("own.*", "added.*")


def _part(windows: DataFrame, part: int, parts: int) -> DataFrame:
    return windows.filter(F.pmod(F.xxhash64("h"), F.lit(parts)) == part)


def _runs(places: str) -> Column:
    """Maximal runs of a sorted list of places, as ``first`` and ``end`` (exclusive)."""
    firsts = F.filter(places, lambda x, i: (i == 0) | (F.get(places, i - 1) != x - 1))
    lasts = F.filter(places, lambda x, i: (i == F.size(places) - 1) | (F.get(places, i + 1) != x + 1))
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("end")))


@set_aside
def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", remove: str = "spans", **options
) -> DataFrame:
    """``docs`` without test passages. ``remove="documents"`` drops every document with a hit;
    ``"spans"`` takes out the words of each span with what separates them from the next word,
    and leaves all else as it was."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    found = contamination(docs, benchmark, window, text_col, **options)
    if remove == "documents":
        return found.filter("n_hit = 0")
    clean, text = found.filter("n_hit = 0"), F.col(text_col)
    hit = found.filter("n_hit > 0").select(
        F.struct(*found.columns).alias("own"),
        F.array_remove(F.split(text, CASED_BETWEEN), "").alias("words"),
        F.split(text, CASED_WORD, -1).alias("gaps"),
        F.concat(F.array(F.lit(0)), F.col("spans.end")).alias("froms"),
    )
    hit = hit.withColumn("pieces", F.zip_with("words", F.slice("gaps", F.lit(2), F.size("words")), lambda word, gap: F.concat(word, gap)))
    upto = lambda i: F.coalesce(F.get("own.spans.first", i), F.size("pieces"))
    left = F.transform("froms", lambda at, i: F.array_join(F.slice("pieces", at + 1, upto(i) - at), ""))
    hit = hit.select("own", F.concat(F.get("gaps", F.lit(0)), F.array_join(left, "")).alias("rest"))
    return clean.unionByName(
        hit.select(*[F.col("rest" if c == text_col else f"own.`{c}`").alias(c) for c in found.columns])
    )
