"""Polls thinned to reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.fold import latest_per_name
from tallyfold.schema import REPORT_INTERVAL


def _windowed(polls: DataFrame, interval: str) -> DataFrame:
    return polls.withColumn("report", F.window("ts", interval))


def report_windows(polls: DataFrame, interval: str = REPORT_INTERVAL) -> DataFrame:
    """The newest record per client and name in each report window."""
    newest = latest_per_name(_windowed(polls, interval), "report", "client")
    return newest.select(
        F.col("report.start").alias("window_start"), *[c for c in newest.columns if c != "report"]
    )


def polls_per_report(polls: DataFrame, interval: str = REPORT_INTERVAL) -> DataFrame:
    """Polls per client in each report window; ``polls`` has one row per poll."""
    counted = _windowed(polls, interval).groupBy("report", "client").agg(F.count("*").alias("polls"))
    return counted.select(F.col("report.start").alias("window_start"), "client", "polls")
