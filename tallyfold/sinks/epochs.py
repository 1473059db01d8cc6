"""Tables made of epochs.

A writer's epoch is one folder, ``writer=<name>/epoch=<number>``, and writing it again
replaces it: a job that died, or a replayed micro-batch, is put right by the same call
with the same rows, and nothing is added twice. Writers never touch each other's folders.
The table is what an aggregation over all epochs makes of them, so it can be read at any
time; of an epoch that is just being written, or whose job died, a reader may see some keys
only until the call is repeated.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PART = T.StructType([T.StructField("writer", T.StringType()), T.StructField("epoch", T.LongType())])


def write_epoch(rows: DataFrame, path: str, writer: str, epoch: int, *partitions: str) -> None:
    """Make ``rows`` the content of the writer's epoch; ``partitions`` are folders below it."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", writer):
        raise ValueError(f"{writer!r} cannot name a folder")
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    out.partitionBy(*partitions).parquet(f"{path}/writer={writer}/epoch={epoch}")


def read_epochs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all epochs with their ``writer`` and ``epoch``; none before the first."""
    whole = T.StructType([*schema.fields, *PART.fields])
    rows = rows_at(spark.read.schema(whole).parquet, path)
    return spark.createDataFrame([], whole) if rows is None else rows.select(*whole.fieldNames())


def rows_at(read: Callable[[str], DataFrame], path: str) -> DataFrame | None:
    """``read(path)``, or None where there is no such folder yet."""
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
