"""Keyed upsert into stored state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.schema import STATE, STATE_KEY
from tallyfold.sinks.epochs import PART, read_epochs, write_epoch
from tallyfold.sources.state_table import merged_epochs

# Older than every epoch of a writer: what a restore found, and what a compaction merged.
RESTORE, RESTORE_EPOCH = "restore", -2
COMPACTED, COMPACTED_EPOCH = "compacted", -1


def upsert_state(newer: DataFrame, path: str, writer: str, epoch: int) -> None:
    """Counters add, the gauge that arrived last stays, first-seen times stay.

    Only the keys of ``newer`` are written, sorted by name, in as many files as their size
    asks for. The same ``(writer, epoch)`` again replaces what it wrote: a repeated call
    changes nothing, and puts right what a job that died left.
    """
    rows = newer.select(*STATE.fieldNames()).repartitionByRange("metric_type", "name")
    write_epoch(rows.sortWithinPartitions("metric_type", "name"), path, writer, epoch, "metric_type")


def restore_state(restored: DataFrame, path: str) -> None:
    """Begin a table with ``restored``, unless a writer has added to it already. A restore
    that died is done again as a whole."""
    if read_epochs(restored.sparkSession, path, STATE).where(F.col("writer") != RESTORE).isEmpty():
        upsert_state(restored, path, RESTORE, RESTORE_EPOCH)


def compact_state(spark: SparkSession, path: str, target: str) -> None:
    """Write the table at ``path`` to the new folder ``target`` with its epochs merged.

    The newest epoch of each writer stays as it is, so that a replay of it still replaces
    it. Run it while no writer adds to ``path``; writers go on with ``target``, and until
    this job has ended with ``path``.
    """
    rows = read_epochs(spark, path, STATE)
    newest = rows.where(F.col("writer") != COMPACTED).groupBy("writer").agg(F.max("epoch").alias("epoch"))
    kept = rows.join(newest, ["writer", "epoch"], "left_semi")
    merged = merged_epochs(rows.join(newest, ["writer", "epoch"], "left_anti")).withColumns(
        {"writer": F.lit(COMPACTED), "epoch": F.lit(COMPACTED_EPOCH).cast("bigint")}
    )
    order = [*PART.fieldNames(), *reversed(STATE_KEY)]
    both = kept.unionByName(merged).repartitionByRange(*order).sortWithinPartitions(*order)
    both.write.partitionBy(*PART.fieldNames(), "metric_type").parquet(target)


def stage_state_jdbc(newer: DataFrame, url: str, staging_table: str, **options: str) -> None:
    """Batch state into a database staging table, from which the database upserts.

    The table is truncated and refilled, so a repeated run stages the same rows.
    """
    newer.select("name", "metric_type", "gauge_value", "counter_value").write.option(
        "truncate", "true"
    ).jdbc(url, staging_table, mode="overwrite", properties=options)
