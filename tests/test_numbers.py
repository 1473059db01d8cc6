import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.numbers import exact_sum, gauge_text, parse_float64, parse_int64, wrap_int64

INTEGERS = {
    "5": 5, "+5": 5, "-5": -5, "007": 7, "-0": 0,
    "9223372036854775807": 2**63 - 1, "-9223372036854775808": -(2**63),
    "9223372036854775808": None, "10.66": None, " 5": None, "5 ": None, "5d": None, "": None,
    "1_000": None, "0x10": None, "abc": None, "+": None, "1e3": None,
}
FLOATS = {
    "20.55": 20.55, "5": 5.0, "1.": 1.0, ".5": 0.5, "-.5e3": -500.0, "+1E-2": 0.01,
    "1_000.5": 1000.5, "0x1p3": 8.0, "0X1.8p1": 3.0, "-0x.8P-1": -0.25, "1e-400": 0.0,
    "inf": math.inf, "+Inf": math.inf, "-INFINITY": -math.inf,
    "ABC": None, "1e400": None, "-1e400": None, " 5": None, "5 ": None, "5d": None, "5f": None,
    "": None, ".": None, "1__0": None, "_1": None, "1_": None, "0x10": None, "+nan": None,
    "infi": None, "1e": None, "e5": None,
}


def test_integer_text(spark):
    rows = spark.createDataFrame([(t,) for t in INTEGERS], "t string")
    got = {r.t: r.v for r in rows.select("t", parse_int64(F.col("t")).alias("v")).collect()}
    assert got == INTEGERS


def test_float_text(spark):
    rows = spark.createDataFrame([(t,) for t in [*FLOATS, "NaN", "nan"]], "t string")
    got = {r.t: r.v for r in rows.select("t", parse_float64(F.col("t")).alias("v")).collect()}
    assert math.isnan(got.pop("NaN")) and math.isnan(got.pop("nan"))
    assert got == FLOATS


TEXTS = [
    (10.0, "10"), (12.3, "12.3"), (0.0, "0"), (-0.0, "-0"), (20.55, "20.55"), (-87.3, "-87.3"),
    (1e-4, "0.0001"), (1.2345e-4, "0.00012345"), (1e-5, "1e-05"), (1.5e-7, "1.5e-07"),
    (100000.0, "100000"), (999999.5, "999999.5"), (1e6, "1e+06"), (1234567.0, "1.234567e+06"),
    (1e20, "1e+20"), (1e21, "1e+21"), (1e100, "1e+100"), (-2.5e-10, "-2.5e-10"),
    (1e23, "1e+23"), (0.1 + 0.2, "0.30000000000000004"),
    (math.nan, "NaN"), (math.inf, "+Inf"), (-math.inf, "-Inf"), (None, None),
]


def test_gauge_text(spark):
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(TEXTS)], "i int, v double")
    got = {r.i: r.t for r in rows.select("i", gauge_text(F.col("v")).alias("t")).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [t for _, t in TEXTS]


def test_gauge_text_reads_back(spark):
    random.seed(3)
    doubles = [struct.unpack("d", struct.pack("Q", random.getrandbits(64)))[0] for _ in range(5000)]
    doubles = [d for d in doubles if math.isfinite(d)]
    doubles += [random.uniform(-1, 1) * 10 ** random.randint(-8, 25) for _ in range(5000)]
    rows = spark.createDataFrame([(d,) for d in doubles], "v double")
    for row in rows.select("v", gauge_text(F.col("v")).alias("t")).collect():
        assert float(row.t) == row.v
        digits = row.t.lstrip("-").split("e")[0].replace(".", "").strip("0")
        shortest = repr(abs(row.v)).split("e")[0].replace(".", "").strip("0")
        assert len(digits) <= len(shortest) or abs(row.v) < 1e-300


@pytest.mark.parametrize(
    "numbers",
    [
        [2**63 - 1, 1],
        [2**63 - 1, 2**63 - 1, 5],
        [-(2**63), -1],
        [-(2**63)] * 3 + [7],
        [2**63 - 1, 1, -5],
        [0],
        [-1, -2, -3],
    ],
)
def test_totals_beyond_64_bits(spark, numbers):
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    got = rows.agg(exact_sum(F.col("n")).alias("t"), wrap_int64(exact_sum(F.col("n"))).alias("w")).first()
    total = sum(numbers)
    assert int(got.t) == total
    assert got.w == (total + 2**63) % 2**64 - 2**63


def test_total_of_nothing_is_null(spark):
    assert spark.createDataFrame([(None,)], "n bigint").agg(exact_sum(F.col("n"))).first()[0] is None
