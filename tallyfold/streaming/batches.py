"""Outgoing batches of a stream: a client's updates leave once its chunk is full.

What a client has sent and what waits in its open chunk is one row of state, with fewer than
``size`` updates in it. A micro-batch takes the state of the clients it brings, chunks
waiting and new updates together, delivers the full chunks and writes the new state of those
clients under its epoch, which a replay replaces. So an interval costs what came. The
updates themselves are numbered as in a batch job, in ranges, so no client is one task.

Chunks follow ``seq`` within what has come: over a stream in order they equal those of
``chunk_updates``; an update that comes late joins the chunk that is open then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyfold.functions.render import update_json
from tallyfold.operators.batches import bodies_of, chunk_updates, gather_chunks
from tallyfold.schema import OUTGOING_BATCH_SIZE, SEQ, UNKNOWN_CLIENT
from tallyfold.session import staged
from tallyfold.sinks.epochs import rows_at
from tallyfold.streaming.keyed import since_full
from tallyfold.streaming.state import _trigger

_WAITING = T.ArrayType(T.StructType([T.StructField("seq", SEQ), T.StructField("update", T.StringType())]))
_STATE = T.StructType(
    [
        T.StructField("client", T.StringType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("rows", _WAITING),
        T.StructField("full", T.BooleanType()),
        T.StructField("epoch", T.LongType()),
    ]
)


def _open_chunks(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """``(client, chunk, rows)``: the number and content of every client's open chunk."""
    rows = rows_at(spark.read.schema(_STATE).parquet, f"{path}/open")
    if rows is None:
        return spark.createDataFrame([], _STATE).select("client", "chunk", "rows")
    if before is not None:
        rows = rows.where(F.col("epoch") < before)
    newest = since_full(rows).groupBy("client").agg(F.max_by(F.struct("chunk", "rows"), "epoch").alias("_open"))
    return newest.select("client", "_open.*")


def _deliver(came: DataFrame, epoch: int, path: str, size: int, key: str, full_every: int) -> None:
    spark = came.sparkSession
    record = update_json(F.col("name"), F.col("metric_type"), F.col("delta"), F.col("value"))
    client = F.coalesce("client", F.lit(UNKNOWN_CLIENT)).alias("client")
    new = staged(came.select(client, F.col("seq").cast(SEQ).alias("seq"), record.alias("update")), "came")
    touched = _open_chunks(spark, path, epoch).join(new.select("client").distinct(), "client", "left_semi")
    touched = staged(touched, "open")
    waiting = touched.select("client", F.inline("rows"))
    chunks = gather_chunks(chunk_updates(new.unionByName(waiting), size))
    before = touched.select("client", F.col("chunk").alias("_before"))
    numbered = chunks.join(before, "client", "left").select(
        "client", (F.coalesce("_before", F.lit(0)) + F.col("chunk")).alias("chunk"), "rows"
    )
    numbered = staged(numbered, "chunks")
    full = F.size("rows") == size
    bodies_of(numbered.where(full), key).write.mode("overwrite").parquet(f"{path}/bodies/epoch={epoch}")
    # The last chunk stays open; if it was full, the next one is, and is empty.
    last = numbered.groupBy("client").agg(F.max_by(F.struct("chunk", "rows"), "chunk").alias("_last"))
    last = last.select("client", "_last.*")
    empty = F.array().cast(_WAITING)
    opened = last.select(
        "client",
        F.when(full, F.col("chunk") + 1).otherwise(F.col("chunk")).alias("chunk"),
        F.when(full, empty).otherwise(F.col("rows")).alias("rows"),
    )
    opened.write.mode("overwrite").parquet(f"{path}/open/full=false/epoch={epoch}")
    if full_every and epoch % full_every == full_every - 1:
        whole = _open_chunks(spark, path, epoch + 1)
        whole.write.mode("overwrite").parquet(f"{path}/open/full=true/epoch={epoch}")


def run_batches(
    updates: DataFrame,
    path: str,
    checkpoint: str,
    size: int = OUTGOING_BATCH_SIZE,
    key: str = "",
    full_every: int = 0,
    interval_seconds: int = 0,
) -> StreamingQuery:
    """Pack a stream of accepted updates into bodies below ``path``; see ``read_batches``.

    Every so manieth epoch also writes the state of all clients (0: never), so that the
    state of earlier epochs need not be read any more.
    """

    def deliver(came: DataFrame, epoch: int) -> None:
        _deliver(came, epoch, path, size, key, full_every)

    return (
        updates.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval_seconds))
        .start()
    )


def read_batches(spark: SparkSession, path: str, key: str = "", waiting: bool = False) -> DataFrame:
    """``(client, chunk, updates, body, digest)`` of all full chunks, and with ``waiting``
    also of the open ones, as if they were sent now."""
    bodies = spark.read.parquet(f"{path}/bodies").drop("epoch")
    if not waiting:
        return bodies
    return bodies.unionByName(bodies_of(_open_chunks(spark, path).where(F.size("rows") > 0), key))
