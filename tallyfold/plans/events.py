"""The ``events`` table seen as metric updates.

Ten events form a batch. Bad rows are made by rule: every 17th event has an
unknown type, every 46th counter lacks its delta, every 23rd gauge its value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.ordering import seq_of
from tallyfold.session import new_work_dir

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    """The events as a stream of ``files`` micro-batches, out of order: each holds every
    so manieth batch of ten."""
    folder = new_work_dir(spark, "event-files")
    part = F.expr(f"event_id div 10 % {files}").alias("part")
    dealt = read_events(spark, sf_dir).select("*", part).repartition(files, "part")
    dealt.write.partitionBy("part").parquet(folder)
    return _one_by_one(spark, folder)


def stream_events_in_order(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    """The same in order: each micro-batch holds the next so manieth part of the ids."""
    folder = new_work_dir(spark, "event-files")
    events = read_events(spark, sf_dir)
    last = events.agg(F.max("event_id")).first()[0] or 0
    for part in range(files):  # files are read by the time they were written
        low, high = (last + 1) * part // files, (last + 1) * (part + 1) // files
        some = events.where(f"coalesce(event_id, 0) >= {low} and coalesce(event_id, 0) < {high}")
        some.coalesce(1).write.parquet(f"{folder}/part={part}")
    return _one_by_one(spark, folder)


def _one_by_one(spark: SparkSession, folder: str) -> DataFrame:
    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
    return stream.parquet(f"{folder}/part=*")


def as_updates(events: DataFrame) -> DataFrame:
    """Update rows of the batch form."""
    rows = events.selectExpr(
        "event_id div 10 as batch_id",
        "event_id % 10 as pos",
        "ts",
        "concat('10.0.0.', cast(user_id as string)) as client",
        "'batch' as form",
        "event_type as name",
        "case when event_id % 17 = 0 then 'histogram' "
        "when event_id % 2 = 0 then 'counter' else 'gauge' end as metric_type",
        "case when event_id % 2 = 0 and event_id % 46 <> 0 "
        "then cast(get_json_object(props, '$.k') as bigint) end as delta",
        "case when event_id % 2 = 1 and event_id % 23 <> 0 then value end as value",
    )
    return rows.select(seq_of(F.col("batch_id"), F.col("pos")).alias("seq"), *rows.columns)


def updates_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_updates(read_events(spark, sf_dir))


def every(n: int, remainder: int = 0) -> Column:
    """Condition on the event behind an update row."""
    return F.expr(f"(batch_id * 10 + pos) % {n} = {remainder}")
