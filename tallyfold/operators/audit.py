"""Audit events of accepted requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.classes import OK, fails_batch
from tallyfold.functions.ordering import unix_seconds
from tallyfold.schema import UNKNOWN_CLIENT


def _address(client: Column) -> Column:
    return F.coalesce(client, F.lit(UNKNOWN_CLIENT))


def audit_single(judged: DataFrame) -> DataFrame:
    """One event with one id per applied update."""
    applied = judged.where(F.col("update_class") == OK)
    return applied.select(
        unix_seconds(applied, "ts").alias("ts"),
        F.array("name").alias("metrics"),
        _address(F.col("client")).alias("ip_address"),
    )


def audit_bodies(judged: DataFrame) -> DataFrame:
    """One event per accepted batch of ``judge_batches``; no shuffle."""
    accepted = judged.where(F.col("audit_ids").isNotNull())
    return accepted.select(
        unix_seconds(accepted, "ts").alias("ts"),
        F.col("audit_ids").alias("metrics"),
        _address(F.col("client")).alias("ip_address"),
    )


def audit_batches(judged: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """One event per accepted batch for batches already split into rows.

    Ids keep their order, duplicates and unknown types. A batch with a bad row is
    left out by the same aggregation that lists the ids. Empty batches have no
    rows: give the list ``batches(batch_id, ts, client)`` to get ``[]`` for them.
    """
    grouped = judged.groupBy("batch_id").agg(
        F.bool_or(fails_batch(F.col("update_class"))).alias("_failed"),
        F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("_ids"),
        F.max("ts").alias("ts"),
        F.min_by("client", "pos").alias("client"),
    )
    if batches is not None:
        verdicts = grouped.select("batch_id", "_failed", "_ids")
        grouped = batches.select("batch_id", "ts", "client").join(verdicts, "batch_id", "left")
    accepted = grouped.where(~F.coalesce("_failed", F.lit(False)))
    ids = F.transform("_ids", lambda row: row["name"])
    return accepted.select(
        "batch_id",
        unix_seconds(accepted, "ts").alias("ts"),
        F.coalesce(ids, F.array().cast("array<string>")).alias("metrics"),
        _address(F.col("client")).alias("ip_address"),
    )
