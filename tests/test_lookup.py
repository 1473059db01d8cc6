from tallyfold.operators import lookup
from tests.helpers import state


def some_state(spark):
    return state(
        spark,
        [("PollCount", "counter", None, 1), ("CMD", "gauge", 10.5, None), ("Alloc", "gauge", 1e6, None), ("b", "counter", None, 10), ("a", "counter", None, 9)],
    )


REQUESTS = [
    (1, "PollCount", "counter"), (2, "SomeMetric", "counter"), (3, "CMD", "gauge"), (4, "PollCount", "gauge"),
    (5, "CMD", "histogram"), (6, "nobody", ""), (7, "CMD", None), (8, "PollCount", "counter"),
]


def test_lookup_statuses(spark):
    requests = spark.createDataFrame(REQUESTS, "i int, name string, metric_type string")
    answers = lookup.answer_lookups(requests, some_state(spark)).collect()
    got = {r.i: (r.http_status, r.counter_value, r.gauge_value, r.value_text) for r in answers}
    assert got == {
        1: (200, 1, None, "1"), 2: (404, None, None, None), 3: (200, None, 10.5, "10.5"), 4: (404, None, None, None),
        5: (200, None, None, ""), 6: (200, None, None, ""), 7: (200, None, None, ""), 8: (200, 1, None, "1"),
    }


def test_replies_are_the_stored_record(spark):
    requests = spark.createDataFrame(REQUESTS, "i int, name string, metric_type string")
    got = {r.i: r.reply for r in lookup.answer_lookups(requests, some_state(spark)).collect()}
    assert got[1] == '{"id":"PollCount","type":"counter","delta":1}'
    assert got[2] is None
    assert got[3] == '{"id":"CMD","type":"gauge","value":10.5}'
    assert got[5] == '{"id":"CMD","type":"histogram"}'


def test_splitting_frequent_keys_changes_nothing(spark):
    rows = [(i, "PollCount", "counter") for i in range(300)] + [(300 + i, f"x{i}", "gauge") for i in range(30)]
    rows += [(400, "CMD", "gauge"), (401, "CMD", None)]
    requests = spark.createDataFrame(rows, "i int, name string, metric_type string")
    plain = lookup.answer_lookups(requests, some_state(spark), share=1)
    spread = lookup.answer_lookups(requests, some_state(spark), share=1000)
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))


def test_split_by_type_and_point(spark):
    full = some_state(spark)
    assert {r.name for r in lookup.all_gauges(full).collect()} == {"CMD", "Alloc"}
    assert {r.name: r.counter_value for r in lookup.all_counters(full).collect()} == {"PollCount": 1, "a": 9, "b": 10}
    assert lookup.point_lookup(full, "gauge", "CMD").count() == 1
    assert lookup.point_lookup(full, "gauge", "UNKNOWN").count() == 0
    assert lookup.point_lookup(full, "counter", "CMD").count() == 0


def test_listing_is_ordered(spark):
    assert [tuple(r) for r in lookup.listing(some_state(spark)).collect()] == [
        (1, "PollCount", "1"), (1, "a", "9"), (1, "b", "10"), (2, "Alloc", "1e+06"), (2, "CMD", "10.5"),
    ]
