import numpy as np
import pytest

from tallyfold.llm import line_dedup as L
from tests.llm.rows import awkward_docs, no_docs

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def brute(rows, min_chars=20, min_docs=3):
    holders = {}
    for i, (doc_id, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, {})[i] = L.NO_ID if doc_id is None else doc_id
    lost = {k: max(h.values()) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = L.NO_ID if doc_id is None else doc_id
        kept = [x for x in lines if lost.get(key(x), own) == own]
        out.append((str(doc_id), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def result(frame):
    return sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_dropped"]) for r in frame.collect())


@pytest.mark.parametrize("extra", [False, True])
def test_documents_equal_brute_force(spark, extra):
    docs = awkward_docs(spark, extra)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(w[3] for w in want) > 0
    found = L.drop_repeated_lines(docs)
    assert result(found) == want
    assert set(docs.columns) <= set(found.columns)


def test_many_shards_salts_and_ties(spark):
    lines = [f"a line that is long enough {i:03d}" for i in range(200)]
    rows = [(d, "\n".join(lines[i] for i in range(200) if (i * d) % 7 < 3)) for d in range(1, 12)]
    rows += [(11, rows[-1][1]), (None, lines[5]), (None, None), (20, "È" * 19 + "\n" + "È" * 20), (21, "é" * 20), (22, "È" * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(L.drop_repeated_lines(docs, keys_per_shard=8, salts=3)) == brute(rows)


def test_repeats_without_an_id_all_stay(spark):
    rows = [(None, "the very same line of text")] * 3
    assert result(L.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_shard_is_minimal_and_knows_its_keys():
    rng = np.random.default_rng(1)
    h, fp = (rng.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(2))
    h[1] = h[0]  # equal first hashes, different fingerprints
    shard = L.Shard.load(L.Shard.build(h, fp, np.arange(5000), np.arange(5000) * 3).dump())
    slots = shard.probe(h, fp)
    assert sorted(slots) == list(range(5000))
    assert (shard.count[slots] == np.arange(5000)).all() and (shard.last[slots] == np.arange(5000) * 3).all()
    assert (shard.probe(fp, h) == -1).all()
    assert shard.hashed.bits.size < 5000 * 8


def test_no_rows(spark):
    assert L.drop_repeated_lines(no_docs(spark)).count() == 0
