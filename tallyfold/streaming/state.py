"""Continuous state, its restart, and periodic snapshots of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyfold.operators.fold import fold_updates
from tallyfold.schema import STORE_INTERVAL_SECONDS
from tallyfold.sinks.snapshot import load_snapshot, newest_save, save_snapshot
from tallyfold.sinks.state_table import restore_state, upsert_state


def _trigger(seconds: int) -> dict:
    """An interval, or one run over what is there when it is 0."""
    return {"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True}


def continuous_state(updates: DataFrame) -> DataFrame:
    """State over a stream of accepted updates, for output mode update or complete."""
    return fold_updates(updates)


def run_state_table(
    updates: DataFrame,
    path: str,
    checkpoint: str,
    writer: str,
    snapshot: str | None = None,
    interval_seconds: int = 0,
) -> StreamingQuery:
    """Keep the state table at ``path`` up to date from a stream of accepted updates.

    Each micro-batch is folded and written as an epoch of the table; a replay
    replaces it and adds nothing twice. ``writer`` names this query's checkpoint: keep
    both together, and take a new name with a new checkpoint. A cold start first
    restores ``snapshot``; since a restore adds counters, it happens only while no
    writer has added to the table.
    """
    spark = updates.sparkSession
    restored = None if snapshot is None else load_snapshot(spark, snapshot)
    if restored is not None:
        restore_state(restored, path)

    def merge(batch: DataFrame, epoch: int) -> None:
        upsert_state(fold_updates(batch), path, writer, epoch)

    return (
        updates.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval_seconds))
        .start()
    )


def run_snapshots(
    updates: DataFrame,
    path: str,
    checkpoint: str,
    writer: str,
    interval_seconds: int = STORE_INTERVAL_SECONDS,
) -> StreamingQuery:
    """Save the entire state every interval; 0 saves once and stops."""

    def save(state: DataFrame, epoch: int) -> None:
        newest = newest_save(state.sparkSession, path)
        if newest is None or newest.writer != writer or newest.epoch < epoch:
            save_snapshot(state, path, writer=writer, epoch=epoch)

    return (
        continuous_state(updates)
        .writeStream.outputMode("complete")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval_seconds))
        .start()
    )
