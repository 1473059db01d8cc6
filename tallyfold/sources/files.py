"""Request bodies from files. Gzip is undone by the file source from the suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUEST = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("client", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Logged requests as JSON lines, plain or ``.gz``."""
    return spark.read.schema(REQUEST).json(path)


def stream_requests(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same folder as a stream; the rate option bounds one micro-batch."""
    return (
        spark.readStream.schema(REQUEST)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Bare bodies, one per line, plain or ``.gz``."""
    return spark.read.text(path).select(F.col("value").alias("body"))
