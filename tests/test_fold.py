import random

import pytest

from tallyfold.operators import fold
from tests.helpers import one_by_one, state, updates, values


@pytest.mark.parametrize(
    ("deltas", "total"), [([5], 5), ([2, 3, 10], 15), ([-1], -1), ([0], 0), ([5, -7], -2)]
)
def test_counter_accumulates(spark, deltas, total):
    frame = one_by_one(spark, [("requests", "counter", d, None) for d in deltas])
    assert values(fold.fold_updates(frame)) == {("requests", "counter"): total}
    assert [tuple(r) for r in fold.sum_counters(frame).collect()] == [("requests", total)]


@pytest.mark.parametrize("readings", [[87.3], [99.9], [0.0], [1.0, 5.0, 2.0]])
def test_gauge_keeps_the_last(spark, readings):
    frame = one_by_one(spark, [("cpu_usage", "gauge", None, x) for x in readings])
    assert values(fold.fold_updates(frame)) == {("cpu_usage", "gauge"): readings[-1]}
    assert [tuple(r) for r in fold.last_gauges(frame).collect()] == [("cpu_usage", readings[-1])]


def test_last_is_array_order_within_a_batch(spark):
    rows = [(0, 2, "g", "gauge", None, 3.0), (0, 10, "g", "gauge", None, 9.0), (0, 9, "g", "gauge", None, 1.0)]
    assert values(fold.fold_updates(updates(spark, rows))) == {("g", "gauge"): 9.0}


def test_one_batch_of_a_hundred(spark):
    rows = [(0, i, "Counter", "counter", 1, None) for i in range(0, 100, 2)]
    rows += [(0, i, "Gauge", "gauge", None, 12.3) for i in range(1, 100, 2)]
    assert values(fold.fold_updates(updates(spark, rows))) == {
        ("Counter", "counter"): 50, ("Gauge", "gauge"): 12.3,
    }


def test_same_name_once_per_type_and_other_field_ignored(spark):
    frame = one_by_one(spark, [("m", "counter", 2, 7.5), ("m", "gauge", 9, 1.5)])
    got = {r.metric_type: r for r in fold.fold_updates(frame).collect()}
    assert (got["counter"].counter_value, got["counter"].gauge_value) == (2, None)
    assert (got["gauge"].counter_value, got["gauge"].gauge_value) == (None, 1.5)


def test_overflow_wraps_or_is_null(spark):
    frame = one_by_one(spark, [("c", "counter", 2**63 - 1, None), ("c", "counter", 1, None)])
    assert values(fold.fold_updates(frame)) == {("c", "counter"): -(2**63)}
    assert values(fold.fold_updates(frame, fold.NULL)) == {("c", "counter"): None}


def test_merge(spark):
    old = state(spark, [("a", "counter", None, 5), ("g", "gauge", 1.0, None), ("only", "gauge", 7.0, None)])
    new = fold.fold_updates(
        one_by_one(spark, [("a", "counter", 3, None), ("g", "gauge", None, 2.0), ("new", "counter", 1, None)])
    )
    merged = fold.merge_states(old, new)
    assert values(merged) == {
        ("a", "counter"): 8, ("g", "gauge"): 2.0, ("only", "gauge"): 7.0, ("new", "counter"): 1,
    }
    seen = {r.name: r.first_seen for r in merged.collect()}
    assert seen["a"] == {r.name: r.first_seen for r in old.collect()}["a"]


def test_a_key_of_any_batch_and_position(spark):
    rows = [(2**44, 2**20 + 1, "g", "gauge", None, 2.0), (2**44, 5, "g", "gauge", None, 1.0), (2**62, 0, "h", "gauge", None, 3.0)]
    assert values(fold.fold_updates(updates(spark, rows))) == {("g", "gauge"): 2.0, ("h", "gauge"): 3.0}


def test_other_types_keep_their_name(spark):
    frame = one_by_one(spark, [("a", "counter", 1, None), ("a", "histogram", None, 0.5), ("b", None, 3, None)])
    latest = {r.name: (r.metric_type, r.delta, r.value) for r in fold.latest_per_name(frame).collect()}
    assert latest == {"a": ("histogram", None, 0.5), "b": (None, 3, None)}


def test_any_split_folds_to_the_same_state(spark):
    random.seed(11)
    rows = [
        (i, 0, f"m{random.randint(0, 4)}", *random.choice([("counter", random.randint(-9, 9), None), ("gauge", None, random.random())]))
        for i in range(200)
    ]
    frame = updates(spark, rows).persist()
    whole = sorted(map(tuple, fold.fold_updates(frame).collect()), key=str)
    for _ in range(4):
        cuts = sorted(random.sample(range(1, 200), 2))
        edges = [0, *cuts, 200]
        parts = [
            fold.fold_updates(frame.where(f"batch_id >= {a} and batch_id < {b}"))
            for a, b in zip(edges, edges[1:])
        ]
        left = fold.merge_states(fold.merge_states(parts[0], parts[1]), parts[2])
        right = fold.merge_states(parts[0], fold.merge_states(parts[1], parts[2]))
        assert sorted(map(tuple, left.collect()), key=str) == whole
        assert sorted(map(tuple, right.collect()), key=str) == whole


def test_latest_record_per_name_forgets_the_other_type(spark):
    frame = one_by_one(
        spark,
        [("CPU", "gauge", None, 75.25), ("requests", "counter", 15, None), ("both", "counter", 1, None), ("both", "gauge", None, 2.0)],
    )
    latest = {r.name: (r.metric_type, r.delta, r.value) for r in fold.latest_per_name(frame).collect()}
    assert latest == {
        "CPU": ("gauge", None, 75.25), "requests": ("counter", 15, None), "both": ("gauge", None, 2.0),
    }
    newest = {r.name: (r.metric_type, r.delta, r.value) for r in fold.newest_rows(frame).collect()}
    assert newest == latest
