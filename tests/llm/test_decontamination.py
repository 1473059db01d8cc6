import re

import pytest

from tallyfold.llm import decontamination as D
from tests.llm.rows import awkward_docs, no_docs

ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, said in items:
            item = words(said)
            size = min(len(item), window)
            tests = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
            for at in range(len(own) - size + 1):
                if tuple(own[at : at + size]) in tests:
                    hit |= set(range(at, at + size))
                    found.add("" if item_id is None else str(item_id))
        out.append((str(doc_id), len(own), len(hit), sorted(found)))
    return sorted(out)


def result(frame):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in frame.collect())


def tables(spark):
    docs = awkward_docs(spark)
    body = next(r["text"] for r in docs.collect() if r["doc_id"] == 4).split()
    long = next(r["text"] for r in docs.collect() if r["doc_id"] == 10).split()
    items = [
        (1, " ".join(body[3:30])), (2, "; ".join(body[25:40]).upper()), (2, " ".join(long[:14])), (10, " ".join(long[20_000:20_040])),
        (9, "日本"), (4, "licence LINE, word"), (5, None), (6, "--"), (None, " ".join(long[50:61])), (7, "x x x x"), (8, "never met at all"),
    ]
    return docs, spark.createDataFrame(items, ITEMS), items


@pytest.mark.parametrize("window,most", [(10, 1 << 19), (10, 16), (3, 1 << 19)])
def test_hits_equal_brute_force(spark, window, most):
    docs, benchmark, items = tables(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = D.contamination(docs.repartition(3), benchmark, window, max_windows=most)
    want = brute(rows, items, window)
    assert result(found) == want and sum(w[2] for w in want) > 500
    assert set(docs.columns) <= set(found.columns)


def test_spans_go_and_all_else_stays(spark):
    docs, benchmark, _ = tables(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = D.decontaminate(docs, benchmark)
    assert clean.count() == docs.count()
    for row in clean.filter("doc_id is not null").collect():
        own = words(texts[row["doc_id"]])
        gone = {k for s in row["spans"] for k in range(s["first"], s["end"])}
        assert words(row["text"]) == [w for k, w in enumerate(own) if k not in gone] and len(gone) == row["n_hit"]
        if not gone:
            assert row["text"] == texts[row["doc_id"]]
    few = spark.createDataFrame([(1, "Keep (this), then: A test\nitem; goes. And\tthis stays!")], "doc_id long, text string")
    out = D.decontaminate(few, spark.createDataFrame([(1, "a TEST item goes")], ITEMS)).collect()
    assert [r["text"] for r in out] == ["Keep (this), then: And\tthis stays!"]
    kept = D.decontaminate(docs, benchmark, remove="documents")
    assert result(kept) == [r for r in result(D.contamination(docs, benchmark)) if not r[2]]


def test_input_columns_do_not_clash(spark):
    names = ["row", "own", "words", "n_words", "place", "h", "at", "length", "window", "items_of", "hits", "places", "item_lists", "salt", "total", "added", "gaps", "pieces", "froms", "rest"]
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    for name in names:
        docs = docs.selectExpr("*", f"'mine' as `{name}`")
    benchmark = spark.createDataFrame([(1, "b c")], ITEMS)
    for frame in (D.contamination(docs, benchmark), D.decontaminate(docs, benchmark)):
        (row,) = frame.collect()
        assert all(row[n] == "mine" for n in names if n != "n_words") and row["n_words"] == 4 and row["n_hit"] == 2
    assert frame.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "n_words"]


def test_a_passage_of_many_rows_and_no_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) as doc_id", f"if(id % 3 = 0, '{passage}', 'nothing to see here') as text")
    items = spark.createDataFrame([(i, passage) for i in range(20)], ITEMS)
    found = D.contamination(docs, items).groupBy("n_hit").count().collect()
    assert sorted((r["n_hit"], r["count"]) for r in found) == [(0, 2000), (11, 1000)]
    assert D.contamination(no_docs(spark), items).count() == 0
    assert result(D.contamination(docs.limit(2), items.filter("false"))) == [("1", 4, 0, []), ("None", 11, 0, [])]
