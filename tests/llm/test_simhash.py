import random

import numpy as np
import pytest
import xxhash

from tallyfold.llm import simhash as S
from tests.llm.rows import awkward_docs, no_docs


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def roots(values, bits):
    values = sorted(set(values))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin(a ^ b).count("1") <= bits:
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("extra", [False, True])
def test_documents_equal_brute_force(spark, extra):
    docs = awkward_docs(spark, extra)
    rows = S.near_duplicates(docs).collect()
    texts = [(r["doc_id"], plain(r["text"])) for r in docs.collect()]
    root = roots([fp for _, fp in texts], 4)
    first = {}
    for doc_id, fp in texts:
        if doc_id is not None:
            first[root[fp]] = min(doc_id, first.get(root[fp], doc_id))
    want = sorted((str(d), f"{fp:016x}", first.get(root[fp])) for d, fp in texts)
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows) == want


def clustered(seed, n):
    """A dense ball, chains of four-bit steps, and scattered values."""
    rng = random.Random(seed)
    centre, out = rng.getrandbits(64), set()
    for _ in range(n):
        v = centre
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    v = rng.getrandbits(64)
    for _ in range(20):
        for _ in range(4):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out | {rng.getrandbits(64) for _ in range(n)})


@pytest.mark.parametrize("max_bucket", [20_000, 40])
def test_links_join_what_brute_force_joins(spark, max_bucket):
    values = clustered(1, 120)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = S.link_fingerprints(fps, max_bucket=max_bucket)
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in links.select("a", "b").collect())
    got = {r["node"]: r["root"] for r in S.components(links).collect()}
    want = roots(values, 4)
    classes = {}
    for v, s in zip(values, signed):
        classes.setdefault(want[v], set()).add(got.get(s, s))
    assert all(len(found) == 1 for found in classes.values())
    assert len({next(iter(x)) for x in classes.values()}) == len(classes)


def test_dense_groups_leave_a_forest():
    values = np.array(clustered(2, 400), np.uint64)
    a, b = S._linked(np.zeros(len(values), np.int64), values, 4)
    assert len(a) < len(values)


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in S.components(links).collect()}
    assert {got.get(i, i) for i in range(61)} == {0} and got[101] == 100
    assert S.components(links.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = awkward_docs(spark)
    kept = [r["doc_id"] for r in S.drop_near_duplicates(docs).collect()]
    heads = {r["component_id"] for r in S.near_duplicates(docs).collect()}
    assert sorted(map(str, kept)) == sorted(map(str, heads))
    assert kept.count(11) == 1


def test_each_group_keeps_one_row_whatever_its_ids(spark):
    rng = random.Random(9)
    a, b, c, d, e, f = ("".join(rng.choice("abcdefgh ") for _ in range(600)) for _ in range(6))
    rows = [
        (None, a), (None, b), (None, b),  # groups without an id
        (None, c), (7, c),  # an id comes before none
        (5, d), (9, e), (5, e), (9, d), (5, d),  # an id with two texts heads two groups
        (2, f), (3, f), (3, a + " " + b), (1, ""), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "x", "y", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, fp string, n_chars long")
    texts = {plain(t) for _, t in rows}
    root = roots(texts, 4)
    best = {}
    for k, (i, t) in enumerate(rows):
        best.setdefault(root[plain(t)], []).append((i is None, i or 0, k))
    kept = [r["n_chars"] for r in S.drop_near_duplicates(docs).collect()]
    assert len(best) == 8
    assert sorted(kept) == sorted(min(x)[2] for x in best.values())
    assert S.drop_near_duplicates(docs).schema == docs.schema


def test_no_rows(spark):
    assert S.near_duplicates(no_docs(spark)).count() == 0
    assert S.drop_near_duplicates(no_docs(spark)).count() == 0


def test_an_odd_distance_is_refused_whatever_the_data(spark):
    with pytest.raises(ValueError):
        S.link_fingerprints(spark.createDataFrame([(1,), (2,)], "fp long"), max_bits=3)
