import itertools
import random

import numpy as np
import pytest

from tallyfold.llm import spelling as S

ROWS = "word string, n long"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    of = {w: [x for x in counts if near(w, x)] for w in counts}
    form = {}
    for w, others in of.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(of[w]), counts.get(form[w])))
    return sorted(rows)


def result(frame):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect())


def vocabulary(letters="abcé", size=600, seed=5):
    rng = random.Random(seed)
    out = {}
    for _ in range(size):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
        out[word] = int(10 ** rng.uniform(0, 4))
    return out


# Small slices: several to a filter, and each a part with a pass of its own.
@pytest.mark.parametrize("most,blocks", [(64 << 20, 1 << 14), (1, 64), (5 * 8 * 16, 16)])
def test_groups_equal_brute_force(spark, most, blocks):
    counts = vocabulary() | {"日本語": 3, "日本": 40, "😀bc": 2, "bc😀": 5, "aaaaaaa": 9, "aaaaaa": 900, "b" * 5000: 2, "b" * 4999: 30}
    frame = spark.createDataFrame(list(counts.items()), ROWS).repartition(3)
    want = brute(counts)
    assert result(S.group_variants(frame, max_filter_bytes=most, slice_blocks=blocks)) == want
    assert any(w[1] and w[1] != w[2] for w in want) and any(w[4] > 10 for w in want)


def test_ties_repeats_and_nulls(spark):
    rows = [("abcd", 1), ("abcd", 1), (None, 5), ("abce", 20), ("abcf", 20), ("", 3), ("a", 3)]
    assert result(S.group_variants(spark.createDataFrame(rows, ROWS))) == brute({"abcd": 2, "abce": 20, "abcf": 20, "a": 3})
    assert S.group_variants(spark.createDataFrame([], ROWS)).count() == 0
    with pytest.raises(ValueError):
        S.group_variants(spark.createDataFrame(rows, ROWS), ratio=1)


def test_filters_lose_no_word_and_let_few_others_through():
    rng = np.random.default_rng(2)
    words = sorted({"".join(map(chr, rng.integers(97, 123, 8))) for _ in range(20_000)})
    blocks = {8: -(-len(words) * 32 // 64)}
    hashes = S.word_hashes(S.codes_of(words, 8))
    held = np.zeros(blocks[8], np.uint64)
    np.bitwise_or.at(held, S.block_of(hashes, blocks[8]), S.mask_of(hashes))
    filters = S.Filters(blocks, {(8, i): held[i * S.SLICE_BLOCKS : (i + 1) * S.SLICE_BLOCKS].tobytes() for i in range(-(-blocks[8] // S.SLICE_BLOCKS))})
    assert filters.might_have(8, hashes).all() and not filters.might_have(7, hashes).any()
    others = rng.integers(0, 2**63, 100_000).astype(np.uint64) * np.uint64(2)
    assert filters.might_have(8, others).mean() < 0.01


def test_edits_are_the_words_one_deletion_or_greater_letter_away():
    words = ["abba", "abbb", "bbba"]
    everything = S.Filters({3: 1, 4: 1}, {(n, 0): np.array([2**64 - 1], np.uint64).tobytes() for n in (3, 4)})
    found = sorted(S.possible_edits(words, 4, everything, np.array([ord(c) for c in "abc"], np.uint32)))
    want = set()
    for i, w in enumerate(words):
        want |= {(i, w[:p] + w[p + 1 :]) for p in range(4)}
        want |= {(i, w[:p] + c + w[p + 1 :]) for p, c in itertools.product(range(4), "abc") if c > w[p]}
    assert found == sorted(want)
