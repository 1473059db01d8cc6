"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyfold")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Recording the call site of every column expression costs more than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Without ``spark.checkpoint.dir`` it lies in the warehouse, which is shared too.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/tallyfold-work").rstrip("/")


def staged(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written below the shared folder and read back, so it is worked out once."""
    spark = frame.sparkSession
    folder = new_work_dir(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, never used twice."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
