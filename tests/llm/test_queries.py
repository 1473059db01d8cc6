import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from tests.oracle_check import FAMILY, ordered, plain

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = {n for n in contract.queries() if re.match(r"op\d+_|pipeline$", n)}


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES - {"pipeline"}) == list(range(1, 14))
    assert "pipeline" in NAMES


@pytest.mark.parametrize("name", sorted(NAMES & set(contract.oracle_sql())))
def test_query_equals_sql(spark, name):
    frame = contract.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = ordered([tuple(plain(r[c]) for c in columns) for r in frame.collect()])
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "benchmark", "conversations"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    cursor = connection.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(names) == columns
    assert all(FAMILY[kind] == FAMILY[types[c]] for c, kind in frame.dtypes)
    want = ordered([tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()])
    assert got == want and got


@pytest.mark.parametrize("name", sorted(NAMES - set(contract.oracle_sql())))
def test_other_queries_give_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0
