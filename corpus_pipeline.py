"""The corpus pipeline: documents in, encoded training rows out.

Defined results: null and empty texts are rejected by the first stage, and so is a document
of any id, null too, with under 50 words; rows of the same id are documents of their own up
to mixing, which takes or leaves them together; extra columns are carried up to the last
stage; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import line_dedup, mixing, pieces, simhash
from tallyfold.llm import quality_rules as rules
from tallyfold.llm.common import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or the divergence rule rejects go."""
    return rules.quality_rules(docs).filter("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document all of whose lines went goes too."""
    kept = line_dedup.drop_repeated_lines(docs)
    emptied = (F.col("n_dropped") > 0) & (F.col("n_dropped") == F.col("n_lines"))
    return kept.filter(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's budget of tokens; a document is there once per epoch it is taken in."""
    taken = mixing.mix(mixing.with_domain(docs, mixing.DOMAINS), mixing.WEIGHTS)
    return taken.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training rows: piece ids and their number, instead of the text, and whether they
    decode to it. Each row draws its own merges, by its number in the written table, so a
    document of two epochs is cut in two ways."""
    rows = pieces.encode(docs, pieces.read_model(), occurrence=F.monotonically_increasing_id(), check=True)
    lossless = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces", lossless.alias("lossless")
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_copies),
    ("mixing to target weights", mixture),
    ("piece encoding", encoded),
]

# SimHash fingerprints and piece ids cannot be had in SQL; tests hold each stage and the
# whole run against brute force, the pieces by what they decode to.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
