import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfold.llm import pieces as P
from tests.llm.rows import awkward_docs, no_docs

PROTO = P.read_model()
MODEL = P.PieceModel(PROTO)
TEXT = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" ▁\n\tabcdefghinrst")), max_size=60)


def ids(encoder, text, key="k"):
    return encoder.encode(text, key)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_round_trip(text, dropout):
    assert MODEL.decode(ids(P.Encoder(MODEL, dropout, 3), text)) == text


@settings(max_examples=200, deadline=None)
@given(TEXT.filter(lambda t: "▁" not in t))
def test_without_dropout_equals_the_library(text):
    plain = sentencepiece.SentencePieceProcessor(model_proto=PROTO)
    assert ids(P.Encoder(MODEL, 0.0, 3), text) == plain.encode(text)


def brute(chunk, key, limit):
    """The agenda as a plain list, searched whole for its best candidate each time."""
    parts = [(i, c) for i, c in enumerate(chunk)]
    agenda = {}

    def offer(a, b):
        piece = a[1] + b[1]
        if piece in MODEL.ids:
            agenda[a[0], piece] = (MODEL.order[MODEL.ids[piece]], a[0])

    for a, b in zip(parts, parts[1:]):
        offer(a, b)
    while agenda:
        left, piece = min(agenda, key=agenda.get)
        del agenda[left, piece]
        at = next((n for n, p in enumerate(parts[:-1]) if p[0] == left and p[1] + parts[n + 1][1] == piece), None)
        if at is None or (limit and P._draw(key, left, MODEL.ids[piece]) < limit):
            continue
        parts[at : at + 2] = [(left, piece)]
        if at:
            offer(parts[at - 1], parts[at])
        if at + 1 < len(parts):
            offer(parts[at], parts[at + 1])
    return [i for _, p in parts for i in ([MODEL.ids[p]] if p in MODEL.ids else [MODEL.bytes[b] for b in p.encode()])]


@settings(max_examples=200, deadline=None)
@given(st.text("abcdeinorst ", min_size=1, max_size=14), st.integers(0, 2**64 - 1), st.sampled_from([0, 1 << 61, 1 << 63]))
def test_agenda_equals_brute_force(chunk, key, limit):
    assert MODEL.cut(chunk, key, limit) == brute(chunk, key, limit)
    assert MODEL.cut_many([chunk], np.array([key], np.uint64), limit) == [np.array(brute(chunk, key, limit), np.int32).tobytes()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcdeinorst é日\n", max_size=30), max_size=40), st.sampled_from([0, 1 << 62, 1 << 64]))
def test_many_chunks_at_once(chunks, limit):
    keys = np.arange(len(chunks), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert MODEL.cut_many(chunks, keys, limit) == [np.array(MODEL.cut(c, int(k), limit), np.int32).tobytes() for c, k in zip(chunks, keys)]


def test_dropout_varies_and_repeats():
    text = "the nation is interesting " * 40
    encoder = P.Encoder(MODEL, 0.2, 3)
    first = ids(encoder, text)
    assert first == ids(P.Encoder(MODEL, 0.2, 3), text)
    assert first != ids(P.Encoder(MODEL, 0.2, 4), text) and first != ids(encoder, text, "other")
    assert len(first) > len(ids(P.Encoder(MODEL, 0.0, 3), text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["the", " nation", " interesting", "  x", " é日", " 1", "\n", " " + "ab" * 20]), max_size=60), st.sampled_from([0.0, 0.1, 0.7, 1.0]))
def test_kept_merges_give_what_each_agenda_gives(words, dropout):
    text = "".join(words)
    encoder = P.Encoder(MODEL, dropout, 5)
    chunks = MODEL.chunks.findall(" " + text) if text else []
    want = [i for c, k in zip(chunks, encoder.keys_of("k", 0, len(chunks))) for i in MODEL.cut(c, int(k), encoder.limit)]
    assert ids(encoder, text) == want == ids(encoder, text)


def test_every_occurrence_is_drawn_apart():
    n, encoder = 10_000, P.Encoder(MODEL, 0.1, 3)
    (chunk,) = MODEL.chunks.findall(" a")  # one candidate, so the rate of cuts is that of skips
    whole = np.array(MODEL.cut(chunk), np.int32).tobytes()
    cuts = encoder._cut_all([chunk] * n, encoder.keys_of("k", 0, n))
    assert len(whole) == 4 and 0.09 < sum(c != whole for c in cuts) / n < 0.11
    other = encoder._cut_all([chunk] * n, encoder.keys_of("k#1", 0, n))
    assert sum(a != b for a, b in zip(cuts, other)) > 0.1 * n
    long = " interestingly"
    assert len(set(encoder._cut_all([long] * n, encoder.keys_of("k", 0, n)))) > 30


def test_long_texts_in_blocks_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(P, "_KEPT_CUTS", 50)
    text = "ab  cde " * 200_000 + "y" * 3000
    encoder = P.Encoder(MODEL, 0.1, 3)
    found = ids(encoder, text)
    assert MODEL.decode(found) == text and len(encoder.known) <= 50
    assert found == ids(P.Encoder(MODEL, 0.1, 3), text)


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_documents(spark, extra):
    docs = awkward_docs(spark, extra)
    rows = P.decode(P.encode(docs, PROTO), PROTO).collect()
    assert len(rows) == docs.count()
    both = P.encode(docs, PROTO, check=True)
    assert sorted(map(str, both.collect())) == sorted(map(str, rows)) and both.columns == P.decode(P.encode(docs, PROTO), PROTO).columns
    encoder = P.Encoder(MODEL, 0.1, 7)
    for r in rows:
        assert r["decoded"] == (r["text"] or "")
        assert r["pieces"] == ids(encoder, r["text"] or "", "" if r["doc_id"] is None else str(r["doc_id"]))


def test_input_columns_and_occurrences(spark):
    names = ["row", "key", "_text", "_key", "pieces", "decoded"]
    docs = spark.createDataFrame([(1, "some text")] * 2, "doc_id long, text string").selectExpr("*", *[f"'mine' as {n}" for n in names])
    rows = P.encode(docs, PROTO, dropout=0.5, occurrence=F.monotonically_increasing_id(), check=True).collect()
    assert all(r[n] == "mine" for r in rows for n in names[:4]) and {r["decoded"] for r in rows} == {"some text"}
    assert rows[0]["pieces"] != rows[1]["pieces"]


def test_no_rows(spark):
    assert P.decode(P.encode(no_docs(spark), PROTO), PROTO).count() == 0
