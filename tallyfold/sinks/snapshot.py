"""Snapshot documents on disk."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.snapshot import document_lines, snapshot_documents
from tallyfold.sinks.epochs import rows_at
from tallyfold.sources.snapshot import read_snapshot

_END = "number bigint, writer string, epoch bigint"


def save_snapshot(state: DataFrame, path: str, writer: str = "snapshot", epoch: int = 0) -> None:
    """Replace the snapshot at ``path`` by the whole of ``state``, one line per key.

    Snapshots are written by turns into two folders, and one counts once its end mark is
    written after it: readers keep the former until then, and a save that died is done
    again in the same folder. One job saves at a time.
    """
    spark = state.sparkSession
    newest = newest_save(spark, path)
    number = 0 if newest is None else newest.number + 1
    folder = _folder(path, number)
    documents = snapshot_documents(state).where("skipped = 0")
    lines = documents.select(F.to_json(F.struct("counters", "gauges")).alias("value"), F.lit("rows").alias("part"))
    # This removes the folder with its old end mark first.
    out = lines.write.mode("overwrite").option("partitionOverwriteMode", "static")
    out.partitionBy("part").text(folder)
    mark = json.dumps({"number": number, "writer": writer, "epoch": epoch})
    spark.range(1, numPartitions=1).select(F.lit(mark).alias("value")).write.mode("overwrite").text(f"{folder}/part=end")


def _folder(path: str, number: int) -> str:
    return f"{path}/turn={number % 2}"


def newest_save(spark: SparkSession, path: str) -> Row | None:
    """Number, writer and epoch of the snapshot that counts, from two small files."""
    marks = [_mark(spark, f"{path}/turn={turn}") for turn in (0, 1)]
    return max((mark for mark in marks if mark is not None), key=lambda mark: mark.number, default=None)


def _mark(spark: SparkSession, folder: str) -> Row | None:
    rows = rows_at(spark.read.schema(f"{_END}, part string").json, folder)
    return None if rows is None else rows.where("part = 'end' and number is not null").first()


def load_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """State rows of the snapshot that counts, or None when there is none."""
    newest = newest_save(spark, path)
    # The end mark has neither of the two maps, so it gives no rows.
    return None if newest is None else read_snapshot(spark, _folder(path, newest.number))


def write_document(state: DataFrame, path: str) -> None:
    """The whole state as the one document other tools read, in files that give it when
    they are joined in the order of their names. No task holds more than its own lines."""
    document_lines(state).write.mode("overwrite").text(path)
