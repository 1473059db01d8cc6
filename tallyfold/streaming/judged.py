"""Judged updates of a stream, with their counts by class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyfold.operators.validate import class_counts, write_judged
from tallyfold.streaming.state import _trigger


def run_judged(judged: DataFrame, path: str, checkpoint: str, interval_seconds: int = 0) -> StreamingQuery:
    """Write a stream of classified updates as ``rows/epoch=/side=`` and, from the same pass,
    their counts as ``counts/epoch=``. A replay replaces both."""

    def deliver(batch: DataFrame, epoch: int) -> None:
        counts = write_judged(batch, f"{path}/rows/epoch={epoch}")
        few = class_counts(batch.sparkSession, counts).coalesce(1)
        few.write.mode("overwrite").parquet(f"{path}/counts/epoch={epoch}")

    return (
        judged.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval_seconds))
        .start()
    )


def read_class_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(update_class, updates)`` over all epochs."""
    counts = spark.read.parquet(f"{path}/counts")
    return counts.groupBy("update_class").agg(F.sum("updates").alias("updates"))
