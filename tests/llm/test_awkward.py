"""Columns named like the helpers of an operator, and many rows without an id."""

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import decontamination, line_dedup, mixing, pieces, sharding, simhash
from tallyfold.llm import quality_rules as rules
from tallyfold.llm.common import set_aside
from tests.llm.rows import HELPERS, awkward_docs

OPERATORS = {
    "quality_rules": rules.quality_rules,
    "drop_near_duplicates": simhash.drop_near_duplicates,
    "mixing": lambda docs: mixing.mix(mixing.with_domain(docs, mixing.DOMAINS), mixing.WEIGHTS),
    "line_dedup": line_dedup.drop_repeated_lines,
    "sharding": sharding.assign_shards,
    "pieces": lambda docs: pieces.encode(docs, pieces.read_model()),
    "decontamination": lambda docs: decontamination.decontaminate(
        docs, docs.sparkSession.createDataFrame([("i", "one two three")], "item_id string, text string")
    ),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_of_the_input_keep_their_values(spark, name):
    found = OPERATORS[name](awkward_docs(spark, extra=True))
    kept = [c for c in HELPERS if c in found.columns]
    assert kept in ([], list(HELPERS)) or name == "sharding"
    want = F.concat(F.lit("x"), F.col("doc_id").cast("string"))
    for column in kept:
        assert found.where(~F.col(column).eqNullSafe(want)).count() == 0, column
    plain = OPERATORS[name](awkward_docs(spark))
    assert sorted(str(r.doc_id) for r in found.select("doc_id").collect()) == sorted(str(r.doc_id) for r in plain.select("doc_id").collect())


def test_names_that_are_taken_are_not_given(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "_a int, Aside0 int, b int")
    seen = []

    def operator(rows):
        seen.extend(rows.columns)
        return rows.withColumn("_a", F.lit(9)).drop("_a")

    found = set_aside(operator)(frame)
    assert seen == ["aside1", "Aside0", "b"] and found.columns == frame.columns and found.first() == (1, 2, 3)


def test_rows_without_an_id_are_dealt_by_their_texts(spark):
    line = "the line that all of them have"
    docs = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.concat(F.lit(f"{line}\nof their own: line number "), F.col("id").cast("string")).alias("text"),
    )
    lines = line_dedup.hashed_lines(docs, 20)
    assert lines.where(F.col("doc_id") == line_dedup.NO_ID).select("text_hash").distinct().count() == 100
    found = line_dedup.drop_repeated_lines(docs).collect()
    kept = {r.doc_id for r in found if r.n_dropped == 0}
    assert len(found) == 300 and kept == {299} and all(line not in r.text for r in found if r.n_dropped)
