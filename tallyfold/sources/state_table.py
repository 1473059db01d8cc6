"""Scans of stored state."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.fold import merge_rows
from tallyfold.schema import METRIC_TYPES, SEQ, STATE
from tallyfold.sinks.epochs import read_epochs

# Epochs of a writer; with an arrival order they fit one decimal.
_MOST_EPOCHS = Decimal(10**9)


def read_state(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """A state table, its epochs merged; empty before the first.

    ``metric_type`` is a partition column, so a filter on it skips folders. Files are
    sorted by name: a filter on it, as ``name`` sets one, skips most of what they hold.
    """
    rows = read_epochs(spark, path, STATE)
    return merged_epochs(rows if name is None else rows.where(F.col("name") == name))


def merged_epochs(rows: DataFrame) -> DataFrame:
    """One row per key. Gauges without an arrival order, or with the same, are taken from
    the later epoch; two writers must not give the same order to different gauges."""
    return merge_rows(rows, F.col("epoch") + 2, _MOST_EPOCHS)


def read_state_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """State kept in a database table, one read task per metric type."""
    rows = spark.read.jdbc(
        url,
        table,
        predicates=[f"metric_type = '{kind}'" for kind in METRIC_TYPES],
        properties=options,
    )
    return rows.select(
        "name",
        "metric_type",
        F.col("gauge_value").cast("double").alias("gauge_value"),
        F.col("counter_value").cast("bigint").alias("counter_value"),
        F.col("timestamp").cast("timestamp_ntz").alias("first_seen"),
        F.lit(None).cast(SEQ).alias("gauge_seq"),
    )
