"""Report windows over a stream of polls.

Each micro-batch is thinned to its own windows and written as an epoch of a report table;
epochs are merged when the table is read. There is no watermark: a poll counts however
late it comes, a window can be read at any time, and a replay adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyfold.operators.fold import latest_per_name
from tallyfold.operators.report import polls_per_report, report_windows
from tallyfold.schema import REPORT_INTERVAL, SEQ
from tallyfold.sinks.epochs import read_epochs, write_epoch

_KEYS = [T.StructField("window_start", T.TimestampNTZType()), T.StructField("client", T.StringType())]
_WINDOWS = T.StructType(
    [
        *_KEYS,
        T.StructField("name", T.StringType()),
        T.StructField("metric_type", T.StringType()),
        T.StructField("delta", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("seq", SEQ),
    ]
)
_POLLS = T.StructType([*_KEYS, T.StructField("polls", T.LongType())])


def _run(polls: DataFrame, thin, schema: T.StructType, path: str, checkpoint: str, writer: str) -> StreamingQuery:
    def add(batch: DataFrame, epoch: int) -> None:
        thinned = thin(batch).select(*[F.col(field.name).cast(field.dataType) for field in schema])
        write_epoch(thinned, path, writer, epoch)

    return (
        polls.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_report_windows(
    polls: DataFrame, path: str, checkpoint: str, writer: str, interval: str = REPORT_INTERVAL
) -> StreamingQuery:
    """Keep ``report_windows`` of all polls so far in the table at ``path``."""
    return _run(polls, lambda b: report_windows(b, interval), _WINDOWS, path, checkpoint, writer)


def run_polls_per_report(
    polls: DataFrame, path: str, checkpoint: str, writer: str, interval: str = REPORT_INTERVAL
) -> StreamingQuery:
    """Keep ``polls_per_report`` of all polls so far in the table at ``path``."""
    return _run(polls, lambda b: polls_per_report(b, interval), _POLLS, path, checkpoint, writer)


def read_report_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest record per client and name in each window; empty before the first epoch."""
    return latest_per_name(read_epochs(spark, path, _WINDOWS), "window_start", "client")


def read_polls_per_report(spark: SparkSession, path: str) -> DataFrame:
    """Polls per client in each window; empty before the first epoch."""
    counts = read_epochs(spark, path, _POLLS).groupBy("window_start", "client")
    return counts.agg(F.sum("polls").alias("polls"))
