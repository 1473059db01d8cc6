"""Audit events: the JSON-lines log and delivery to several sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.schema import AUDIT_EVENT

Sink = Callable[[DataFrame, int], None]


def append_audit(events: DataFrame, path: str, writer: str = "batch", epoch: int = 0) -> None:
    """One event per line, in a folder of this writer and epoch: a replay replaces it."""
    folder = f"{path}/epoch={writer}-{epoch}"
    events.select(*AUDIT_EVENT.fieldNames()).write.mode("overwrite").json(folder)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Events of all epochs."""
    return spark.read.schema(AUDIT_EVENT).json(path).select(*AUDIT_EVENT.fieldNames())


def read_indented_audit(spark: SparkSession, path: str) -> DataFrame:
    """Events written back to back as indented objects, without separators.

    Inside JSON text a line break is always escaped and the objects hold no
    others, so a line that starts with a brace can only end an event.
    """
    pieces = spark.read.option("lineSep", "\n}").text(path)
    event = F.from_json(F.concat("value", F.lit("\n}")), AUDIT_EVENT)
    return pieces.where(F.trim("value") != "").select(event.alias("e")).select("e.*")


def fan_out(sinks: Sequence[Sink]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands every event to every sink.

    A failing sink does not keep events from the others; once all were tried the epoch
    fails, so it is replayed, and a sink that replaces its epoch loses and repeats nothing.
    """

    def deliver(events: DataFrame, epoch: int) -> None:
        kept, failed = events.persist(), []
        try:
            for sink in sinks:
                try:
                    sink(kept, epoch)
                except Exception as error:
                    failed.append(error)
        finally:
            kept.unpersist()
        if failed:
            raise ExceptionGroup(f"audit sinks failed in epoch {epoch}", failed)

    return deliver
