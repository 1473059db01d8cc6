"""Compare catalog queries with their SQL: names, types, and all values."""

import datetime
import decimal
import math

import duckdb

from tallyfold.plans.catalog import QUERIES
from tallyfold.plans.oracle import ORACLE_SQL

TABLES = ["events"]
FAMILY = {
    "bigint": "int", "int": "int", "BIGINT": "int", "INTEGER": "int",
    "double": "float", "DOUBLE": "float",
    "string": "text", "VARCHAR": "text",
    "boolean": "bool", "BOOLEAN": "bool",
    "timestamp_ntz": "time", "TIMESTAMP": "time",
}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def compare(spark, name, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = ordered([tuple(plain(r[c]) for c in columns) for r in frame.collect()])
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    cursor = connection.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns, (name, names, columns)
    types = {d[0]: str(d[1]) for d in cursor.description}
    spark_types = dict(frame.dtypes)
    for column in columns:
        assert FAMILY[spark_types[column]] == FAMILY[types[column]], (column, spark_types, types)
    rows = cursor.fetchall()
    positions = [names.index(c) for c in columns]
    want = ordered([tuple(plain(r[p]) for p in positions) for r in rows])
    assert len(got) == len(want), (name, len(got), len(want))
    assert len(got) > 0, name
    for g, w in zip(got, want):
        assert g == w, (name, columns, g, w)
    return len(got)
