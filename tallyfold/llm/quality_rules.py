"""Quality rules: base counts, then divergence from language references.

A document's character-class histogram and its common-word histogram are compared
with the references of its language by Jensen-Shannon distance (base 2, so 0 to 1).
Everything is a column expression over one row: no shuffle, no Python.

Defined results: a null text counts as empty; a document of a language without
reference (or null) is held against every reference and the nearest counts; texts
below the length guards are not judged by that histogram; repeated rows are judged
alike; an empty table gives an empty table. Columns the operator adds replace input
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import set_aside, text_of, words_of

CHAR_CLASSES = ("upper", "letter", "digit", "space", "punctuation", "symbol", "other")

# Share of each character class in running prose, and per thousand
# words how often each common word occurs; rounded from well-known language counts.
_PROSE = (0.03, 0.785, 0.005, 0.155, 0.024, 0.0005, 0.0005)
REFERENCES: dict[str, dict] = {
    "en": {
        "chars": _PROSE,
        "words": {
            "the": 62, "of": 30, "and": 27, "to": 26, "a": 22, "in": 21, "is": 10, "that": 10,
            "was": 9, "it": 9, "for": 9, "on": 7, "with": 7, "as": 7, "be": 6, "at": 5, "by": 5,
            "this": 5, "from": 4, "are": 4,
        },
    },
    "de": {
        "chars": _PROSE,
        "words": {
            "der": 34, "die": 33, "und": 28, "in": 18, "den": 13, "von": 11, "zu": 10, "das": 10,
            "mit": 9, "sich": 8, "des": 8, "auf": 7, "ist": 7, "im": 7, "dem": 7, "nicht": 7,
            "ein": 6, "eine": 5, "als": 5, "auch": 5,
        },
    },
    "fr": {
        "chars": _PROSE,
        "words": {
            "de": 50, "la": 32, "le": 26, "et": 22, "les": 20, "des": 18, "en": 15, "un": 12,
            "du": 12, "une": 11, "que": 10, "est": 10, "pour": 8, "qui": 8, "dans": 8, "a": 7,
            "par": 6, "au": 6, "sur": 6, "avec": 4,
        },
    },
    "es": {
        "chars": _PROSE,
        "words": {
            "de": 60, "la": 40, "que": 30, "el": 29, "en": 26, "y": 25, "a": 19, "los": 17,
            "se": 12, "del": 12, "las": 11, "un": 10, "por": 9, "con": 9, "una": 8, "no": 8,
            "su": 7, "para": 6, "es": 6, "lo": 5,
        },
    },
}


@set_aside
def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and helper columns.

    Windows of three words are sorted by a 64-bit hash, their words and their place, so equal
    ones are neighbours, whatever the hash and however long the text.
    """
    text = text_of()
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    staged = docs.withColumns(
        {
            "_words": words_of(text),
            "_rest": F.regexp_replace(text, r"[\p{L}\x20\x09-\x0D]+", ""),
            "_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")),
            "_lines": lines,
        }
    )
    staged = staged.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": _count("_rest", r"[#*$%&|<>]+"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_sorted": F.sort_array(
                F.transform(
                    F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))),
                    lambda word, i: F.struct(
                        F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"),
                        word.alias("a"), F.get("_words", i + 1).alias("b"), F.get("_words", i + 2).alias("c"),
                        i.alias("at"),
                    ),
                )
            ),
        }
    ).drop("_lines")

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    # Places of each window equal to the next one, with the next one's.
    pairs = F.filter(
        F.transform(
            "_sorted",
            lambda x, k: F.when(same(x, F.get("_sorted", k + 1)), F.array(x["at"], F.get("_sorted", k + 1)["at"])),
        ),
        lambda pair: pair.isNotNull(),
    )
    staged = staged.withColumn("_starts", F.sort_array(F.array_distinct(F.flatten(pairs)))).drop("_sorted")
    # A window covers three words, fewer where the next repeated window begins earlier.
    covered = F.aggregate(
        F.transform("_starts", lambda at, k: F.least(F.lit(3), F.get("_starts", k + 1) - at)),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return staged.withColumn("n_repeat_words", covered).drop("_starts")


def _count(name: str, pattern: str) -> Column:
    return (F.length(name) - F.length(F.regexp_replace(name, pattern, ""))).cast("long")


def histograms(counted: DataFrame, references: Mapping[str, Mapping] = REFERENCES) -> DataFrame:
    """Adds ``_chars`` (counts by CHAR_CLASSES) and ``_common`` (the common words met)."""
    vocabulary = sorted({word for ref in references.values() for word in ref["words"]})
    counted = counted.withColumns(
        {
            "_digit": _count("_rest", "[0-9]+"),
            "_punctuation": _count("_rest", r"[.,;:!?'\"()\[\]{}¿¡«»„“”‘’…\-–—/]+"),
        }
    )
    space = F.length(text_of()) - F.col("word_chars")
    letters = F.col("word_chars") - F.length("_rest") - F.col("_upper")
    other = F.length("_rest") - F.col("_digit") - F.col("_punctuation") - F.col("n_symbols")
    counts = (F.col("_upper"), letters, F.col("_digit"), space, F.col("_punctuation"), F.col("n_symbols"), other)
    return counted.withColumns(
        {
            "_chars": F.array(*[c.cast("double") for c in counts]),
            "_common": F.filter("_words", lambda word: word.isin(vocabulary)),
        }
    ).drop("_digit", "_punctuation")


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length; each is normalised."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    share = lambda a: _let(total(a), lambda t: F.transform(a, lambda x: F.when(t > 0, x / t).otherwise(0.0)))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    both = F.zip_with(
        share(p), share(q), lambda x, y: part(x, (x + y) / 2) / 2 + part(y, (x + y) / 2) / 2
    )
    return F.sqrt(F.greatest(total(both), F.lit(0.0)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def divergence(frame: DataFrame, references: Mapping[str, Mapping], lang_col: str) -> DataFrame:
    """Adds char_distance and word_distance to the nearest reference of the language."""
    refs = F.array(
        *[
            F.struct(
                F.lit(lang).alias("lang"),
                F.array(*[F.lit(float(x)) for x in ref["chars"]]).alias("chars"),
                F.array(*map(F.lit, ref["words"])).alias("words"),
                F.array(
                    *[F.lit(float(x)) for x in (*ref["words"].values(), 1000 - sum(ref["words"].values()))]
                ).alias("shares"),
            )
            for lang, ref in references.items()
        ]
    )
    fitting = refs
    if lang_col in frame.columns:
        known = F.coalesce(F.col(lang_col).isin(list(references)), F.lit(False))
        fitting = F.filter(refs, lambda r: ~known | (r["lang"] == F.col(lang_col)))

    def word_counts(ref: Column, common: Column) -> Column:
        met = F.transform(
            ref["words"],
            lambda word: F.size(F.filter(common, lambda x: x == word)).cast("double"),
        )
        return _let(
            met,
            lambda counts: F.concat(
                counts,
                F.array(F.col("n_words") - F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)),
            ),
        )

    frame = frame.withColumn("_fitting", fitting)
    return frame.withColumns(
        {
            "char_distance": _let(
                F.col("_chars"),
                lambda chars: F.array_min(
                    F.transform("_fitting", lambda r: js_distance(chars, r["chars"]))
                ),
            ),
            "word_distance": _let(
                F.col("_common"),
                lambda common: F.array_min(
                    F.transform("_fitting", lambda r: js_distance(word_counts(r, common), r["shares"]))
                ),
            ),
        }
    ).drop("_fitting")


@set_aside
def quality_rules(
    docs: DataFrame,
    references: Mapping[str, Mapping] = REFERENCES,
    lang_col: str = "lang",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_char_distance: float = 0.30,
    max_word_distance: float = 0.38,
    joint_distances: tuple[float, float] = (0.15, 0.30),
    min_chars: int = 200,
    min_judged_words: int = 100,
) -> DataFrame:
    """Adds the base counts, both distances, ``base_failed`` and ``kept`` to ``docs``.

    ``min_chars`` and ``min_judged_words`` guard the two histograms: below them the
    counts say too little, and the distance is null and rejects nothing. A document is
    rejected beyond either limit, or beyond both of the lower ``joint_distances``.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = [*added, "char_distance", "word_distance", "base_failed", "kept"]
    own = [c for c in docs.columns if c not in judged]
    frame = divergence(histograms(base_counts(docs.select(*own)), references), references, lang_col)
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    guarded = frame.withColumns(
        {
            "char_distance": F.when(F.length(text_of()) >= min_chars, F.col("char_distance")),
            "word_distance": F.when(F.col("n_words") >= min_judged_words, F.col("word_distance")),
            "base_failed": failed,
        }
    )
    chars, words = (F.coalesce(c, F.lit(0.0)) for c in ("char_distance", "word_distance"))
    diverges = (
        (chars > max_char_distance)
        | (words > max_word_distance)
        | ((chars > joint_distances[0]) & (words > joint_distances[1]))
    )
    judged_now = [*map(F.col, judged[:-1]), (~F.col("base_failed") & ~diverges).alias("kept")]
    # A filter on the verdict would be pushed below the projections and work everything out
    # again inside itself, once per word; filters do not pass a generator.
    return guarded.select(*own, F.inline(F.array(F.struct(*judged_now))))


def fit_references(
    docs: DataFrame, words: Mapping[str, list[str]], lang_col: str = "lang"
) -> dict[str, dict]:
    """References from a trusted corpus: class shares and given words' frequencies by language.

    All documents count. One row per language named in ``words`` reaches the driver.
    """
    named = {lang: {"chars": _PROSE, "words": dict.fromkeys(listed, 1)} for lang, listed in words.items()}
    frame = histograms(base_counts(docs.filter(F.col(lang_col).isin(list(words)))), named)
    listed = sorted({w for each in words.values() for w in each})

    def times_met(word: str) -> Column:
        return F.sum(F.size(F.filter("_common", lambda x: x == word)))

    met = [times_met(w).alias(f"w{i}") for i, w in enumerate(listed)]
    kinds = [F.sum(F.get("_chars", F.lit(i))).alias(f"c{i}") for i in range(len(CHAR_CLASSES))]
    rows = frame.groupBy(lang_col).agg(F.sum("n_words").alias("n"), *met, *kinds).collect()
    out = {}
    for row in rows:
        chars = [row[f"c{i}"] or 0.0 for i in range(len(CHAR_CLASSES))]
        total, n = sum(chars) or 1.0, row["n"] or 1
        out[row[lang_col]] = {
            "chars": tuple(c / total for c in chars),
            "words": {w: 1000 * row[f"w{listed.index(w)}"] / n for w in words[row[lang_col]]},
        }
    return out
