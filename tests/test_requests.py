"""Client ids, digests, and requests as text."""

import hashlib

from pyspark.sql import functions as F

from tallyfold.functions.digest import body_digest, digest_matches
from tallyfold.functions.identity import client_id
from tallyfold.functions.render import update_json
from tallyfold.operators.validate import classify, single_outcomes
from tallyfold.sources.updates import explode_batches, parse_batches, parse_paths, parse_updates
from tests.helpers import T0


def test_client_id(spark):
    cases = [
        ("10.1.2.3, 8.8.8.8", "1.1.1.1:80", "10.1.2.3"),
        ("\t10.1.2.3 ", "1.1.1.1:80", "10.1.2.3"),
        (" ,b", "1.1.1.1:80", ""),
        ("", "10.0.0.7:51234", "10.0.0.7"),
        (None, "[::1]:80", "::1"),
        (None, "::1", "::1"),
        (None, "localhost:http", "localhost"),
        (None, "host:", "host"),
        (None, "[::1", "[::1"),
        (None, "socket", "socket"),
        (None, "[a]b:80", "[a]b:80"),
    ]
    rows = spark.createDataFrame([(i, x, a) for i, (x, a, _) in enumerate(cases)], "i int, x string, a string")
    got = {r.i: r.c for r in rows.select("i", client_id(F.col("x"), F.col("a")).alias("c")).collect()}
    assert [got[i] for i in range(len(cases))] == [c for *_, c in cases]


def test_digest(spark):
    good = hashlib.sha256("[żółw]key".encode()).hexdigest()
    rows = spark.createDataFrame(
        [("[żółw]", good), ("[żółw]", good.upper()), ("[żółw]", None)], "body string, header string"
    )
    got = rows.select(
        body_digest(F.col("body"), "key").alias("d"),
        digest_matches(F.col("body"), "key", F.col("header")).alias("m"),
        digest_matches(F.col("body"), "", F.col("header")).alias("unkeyed"),
    ).collect()
    assert [r.d for r in got] == [good] * 3
    assert [r.m for r in got] == [True, False, False]
    assert all(r.unkeyed for r in got)


def test_rendering_leaves_out_absent_fields(spark):
    rows = spark.createDataFrame(
        [(0, "a", "counter", 5, None, ""), (1, "b", "gauge", None, 1.5, "abc"), (2, "c", "counter", 0, None, None)],
        "i int, n string, t string, d bigint, v double, h string",
    )
    got = rows.orderBy("i").select(update_json(*[F.col(c) for c in "ntdvh"])).collect()
    assert [r[0] for r in got] == [
        '{"id":"a","type":"counter","delta":5}',
        '{"id":"b","type":"gauge","value":1.5,"hash":"abc"}',
        '{"id":"c","type":"counter","delta":0}',
    ]


GOOD_BODIES = {
    '{"id":"a","type":"counter","delta":5}': ("a", "counter", 5, None),
    ' {"id":"a","type":"gauge","value":5} ': ("a", "gauge", None, 5.0),
    '{"id":"a","type":"gauge","value":1.5e3,"extra":[1]}': ("a", "gauge", None, 1500.0),
    '{"type":"counter","delta":null}': ("", "counter", None, None),
    '{"id":null,"type":"x"}': ("", "x", None, None),
    '{"id":"a","id":"b","type":"counter","delta":-0}': ("b", "counter", 0, None),
    '{"id":"\\u0041","type":"gauge","value":0.1}': ("A", "gauge", None, 0.1),
    '{"id":"x\\"id\\":5","type":"gauge","value":1}': ('x"id":5', "gauge", None, 1.0),
    "null": ("", "", None, None),
}
BAD_BODIES = [
    "", "x", "[1]", "5", '{"id":"a"', '{"id":"a"} x', '{"id":"a"},{"id":"b"}', '{"id":5}',
    '{"id":"a","type":5}', '{"id":"a","hash":true}', '{"id":"a","delta":"5"}',
    '{"id":"a","delta":1.0}', '{"id":"a","delta":1e2}', '{"id":"a","delta":9223372036854775808}',
    '{"id":"a","value":"1"}', '{"id":"a","value":"NaN"}', '{"id":"a","value":NaN}',
    '{"id":"a","value":1e400}', "{'id':'a'}", '{"id":{"a":1}}', '{"\\u0069d":5}', '{"delta":01}',
]


def test_single_bodies(spark):
    bodies = [*GOOD_BODIES, *BAD_BODIES, None]
    rows = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = {r.body: r for r in parse_updates(rows).collect()}
    for body, record in GOOD_BODIES.items():
        row = got[body]
        assert (row.name, row.metric_type, row.delta, row.value) == record, body
        assert row.malformed is False, body
    for body in [*BAD_BODIES, None]:
        assert got[body].malformed is True, body
        assert got[body].name is None and got[body].delta is None, body


def test_batch_bodies(spark):
    one, two = '{"id":"a","type":"counter","delta":1}', '{"id":"b","type":"gauge","value":2}'
    cases = {
        f"[{one},{two}]": 2, "[]": 0, "null": 0, "[null]": 1, f" [{one}] ": 1,
        f'[{one},{{"id":"c","delta":"1"}}]': None, f'[{one},{{"id":7}}]': None, "[1]": None,
        "[[]]": None, one: None, f"[{one}": None, f"[{one}]]": None, f"[{one}] x": None,
        f"[{one}],[{two}]": None, '[{"id":"a","value":1e999}]': None, "": None,
    }
    rows = spark.createDataFrame([(b,) for b in cases], "body string")
    got = {r.body: (r.malformed, None if r.items is None else len(r.items)) for r in parse_batches(rows).collect()}
    assert got == {b: (n is None, n) for b, n in cases.items()}


def test_exploded_batches_keep_array_order(spark):
    body = '[{"id":"b","type":"counter","delta":1},{"id":"a","type":"gauge","value":2}]'
    rows = spark.createDataFrame([(3, T0, "c", body), (4, T0, "c", "[]")], "batch_id bigint, ts timestamp_ntz, client string, body string")
    got = explode_batches(parse_batches(rows)).orderBy("seq").collect()
    assert [(r.seq, r.batch_id, r.pos, r.name) for r in got] == [
        (3 * 2**31, 3, 0, "b"), (3 * 2**31 + 1, 3, 1, "a"),
    ]


PATHS = [
    ("/update/gauge/CMD/20.55", "ok", 200, True),
    ("/update/gauge//20.55", "missing_id", 404, False),
    ("/update/gauge/CMD/ABC", "bad_value", 400, False),
    ("/update/counter/CMD/20", "ok", 200, True),
    ("/update/counter//20", "missing_id", 404, False),
    ("/update/counter/CMD/10.66", "bad_delta", 400, False),
    ("/update/histogram/CMD/1", "unknown_type", 400, False),
    ("/update/histogram//1", "missing_id", 404, False),
    ("/update/gauge/CMD/NaN", "ok", 200, True),
    ("/update/gauge/CMD/1e400", "bad_value", 400, False),
]


def test_path_requests(spark):
    rows = spark.createDataFrame([(p,) for p, *_ in PATHS], "path string")
    judged = single_outcomes(classify(parse_paths(rows).withColumn("form", F.lit("path"))))
    got = {r.path: (r.update_class, r.http_status, r.applied) for r in judged.collect()}
    assert got == {p: tuple(rest) for p, *rest in PATHS}


def test_other_routes_are_not_found(spark):
    rows = spark.createDataFrame([("/update/gauge/a",), ("/update/gauge/a/1/2",), ("/",), (None,)], "path string")
    judged = single_outcomes(classify(parse_paths(rows).withColumn("form", F.lit("path"))))
    assert {(r.malformed, r.http_status, r.applied) for r in judged.collect()} == {(True, 404, False)}


def test_bodies_cannot_leave_their_wrapping(spark):
    item = '{"id":"a","type":"counter","delta":1}'
    singles = [item + '],"x":[1', item + '],"items":[{"id":"b","type":"counter","delta":7}', item + "]", item + ',{}']
    singles += [item + ']} x', item + ']}', item + ']}{"items":[' + item, item + ' ] , "x":[1', item + '] }\n{"a":[1']
    rows = spark.createDataFrame([(b,) for b in singles], "body string")
    assert all(r.malformed for r in parse_updates(rows).collect())
    lists = [f"[{item}]],\"items\":[[{item}]", f"[{item}],[{item}]", f'[{item}]],"x":[[]']
    rows = spark.createDataFrame([(b,) for b in lists], "body string")
    assert all(r.malformed for r in parse_batches(rows).collect())


def test_brackets_inside_a_body_are_its_own(spark):
    bodies = [
        '{"id":"a","type":"counter","delta":1,"x":[1,{"y":[2]}]}',
        '{"id":"a]} {\\"items\\":[","type":"counter","delta":1}',
        '{"x":{"y":[[],{}]},"id":"a],","type":"counter","delta":1}',
    ]
    rows = spark.createDataFrame([(b,) for b in bodies] + [(f"[{b},{b}]",) for b in bodies], "body string")
    singles = {r.body: r.malformed for r in parse_updates(rows).collect()}
    assert singles == {**{b: False for b in bodies}, **{f"[{b},{b}]": True for b in bodies}}
    lists = parse_batches(rows.withColumns({"batch_id": F.lit(1), "ts": F.current_timestamp()}).where("body like '[%'"))
    assert [(r.malformed, len(r.items)) for r in lists.collect()] == [(False, 2)] * 3


def test_keys_match_in_any_case(spark):
    bodies = {
        '{"ID":"a","Type":"counter","Delta":1}': ("a", "counter", 1, None),
        '{"Id":"ID","TYPE":"gauge","vAlUe" : 2.5}': ("ID", "gauge", None, 2.5),
        '{"id":"x\\"ID\\":1","type":"counter","DELTA":3}': ('x"ID":1', "counter", 3, None),
        '{"id":"a","ID":"b","type":"counter","delta":4}': ("b", "counter", 4, None),
    }
    rows = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = {r.body: (r.name, r.metric_type, r.delta, r.value) for r in parse_updates(rows).collect()}
    assert got == bodies
    listed = spark.createDataFrame([(0, T0, "c", f"[{', '.join(bodies)}]")], "batch_id long, ts timestamp_ntz, client string, body string")
    rows = explode_batches(parse_batches(listed)).orderBy("pos").collect()
    assert [(r.name, r.metric_type, r.delta, r.value) for r in rows] == list(bodies.values())


def test_a_body_of_more_than_a_million_updates(spark):
    many = spark.range(1).selectExpr(
        "0L as batch_id", "timestamp_ntz'2024-01-01 00:00:00' as ts", "'c' as client",
        "concat('[', array_join(transform(sequence(0, 1048577), i -> '{\"id\":\"a\"}'), ','), ']') as body",
    )
    from pyspark.sql import functions as F

    row = explode_batches(parse_batches(many)).agg(F.count("*").alias("n"), F.max("pos").alias("last"), F.max("seq").alias("seq")).first()
    assert (row["n"], row["last"], int(row["seq"])) == (1048578, 1048577, 1048577)
