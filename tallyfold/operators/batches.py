"""Cutting updates into outgoing batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.digest import body_digest
from tallyfold.functions.render import json_list, update_json
from tallyfold.schema import OUTGOING_BATCH_SIZE, UNKNOWN_CLIENT
from tallyfold.session import staged


def chunk_updates(
    updates: DataFrame, size: int = OUTGOING_BATCH_SIZE, group_rows: int = 1_000_000
) -> DataFrame:
    """Adds ``chunk``: the running position per client, in groups of ``size``.

    Numbering a client's rows in one window would put a hot client into one task. Rows are
    dealt into ranges of (client, seq) of at most about ``group_rows`` rows instead, kept in files
    so that the ranges stand; they are numbered within their range, and the rows of the
    client in earlier ranges are added, which takes a window over one count per range.
    """
    named = updates.withColumn("client", F.coalesce("client", F.lit(UNKNOWN_CLIENT)))
    ranges = -(-named.count() // group_rows)
    # Few rows go into as many ranges as their size asks for.
    dealt = named.repartitionByRange(*[ranges] * (ranges > 1), "client", "seq")
    placed = staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    counts = placed.groupBy("client", "_range").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("client").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "client", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("client", "_range").orderBy("seq")
    numbered = placed.withColumn("_row", F.row_number().over(within))
    return numbered.join(offsets, ["client", "_range"]).select(
        *updates.columns,
        F.expr(f"(_before + _row - 1) div {size}").alias("chunk"),
    )


def pack_batches(chunked: DataFrame, key: str = "") -> DataFrame:
    """One body per chunk: a JSON array in arrival order, and its digest.

    A chunk holds at most the chosen number of rows, so each list is small. A chunk with
    a value that JSON has not gets no body.
    """
    record = update_json(F.col("name"), F.col("metric_type"), F.col("delta"), F.col("value"))
    return bodies_of(gather_chunks(chunked.select("client", "chunk", "seq", record.alias("update"))), key)


def gather_chunks(chunked: DataFrame) -> DataFrame:
    """One row per chunk: its ``rows`` of ``(seq, update)`` in arrival order."""
    return chunked.groupBy("client", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("seq", "update"))).alias("rows")
    )


def bodies_of(gathered: DataFrame, key: str = "") -> DataFrame:
    """``(client, chunk, updates, body, digest)`` of gathered chunks."""
    bodies = gathered.select(
        "client",
        "chunk",
        F.size("rows").cast("bigint").alias("updates"),
        json_list(F.transform("rows", lambda row: row["update"])).alias("body"),
    )
    digest = body_digest(F.col("body"), key) if key else F.lit(None).cast("string")
    return bodies.withColumn("digest", digest)
