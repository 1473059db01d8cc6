"""Small awkward tables: nulls, empty and long texts, repeats, clashing column names."""

import random

# Names that operators use for columns of their own on the way.
HELPERS = ("_words", "_text", "_lost", "_key", "_n", "_fit", "_owner", "_hash", "_epochs", "aside0")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_docs(spark, extra=False):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared = "The same licence line, word for word."
    body = line(80)
    rows = [
        (1, None, "en", "src0", None),
        (2, "", "en", "src0", 0),
        (3, "  \n\t\n", None, None, 5),
        (4, body, "en", "src0", len(body)),
        (5, body, "en", "src1", len(body)),
        (6, body.upper() + "\n" + shared, "de", "src2", 1),
        (7, shared + "\n" + line(60) + "\n  " + shared.upper() + " ", "fr", "src3", 1),
        (8, line(70) + "\n" + shared, "xx", "other", 1),
        (9, "é ü ▁ 日本 \\ </s> " + line(55), "es", "src4", 1),
        (10, line(30_000), "en", "src0", 1),
        (11, "x " * 400, "en", "src0", 1),
        (11, "x " * 400, "en", "src0", 1),
        (None, line(64), "en", "src0", 1),
        (13, body + " tail", "en", "src0", 1),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in (*HELPERS, "n_words", "kept", "fp", "root", "n_lines", "tokens", "epoch", "pieces", "score", "shard", "rank"):
            frame = frame.selectExpr("*", f"concat('x', doc_id) as `{name}`")
    return frame


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
