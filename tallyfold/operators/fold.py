"""Folding accepted updates into keyed state.

Every aggregate keeps fixed-width buffers, so Spark combines rows before the
shuffle with hash aggregation: a key that holds a third of all rows leaves each
task as one partial row.
"""

from __future__ import annotations

import functools
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.numbers import exact_sum, wrap_int64
from tallyfold.schema import COUNTER, GAUGE, SEQ, STATE, STATE_KEY

WRAP, NULL = "wrap", "null"


def _counter_total(delta: Column, overflow: str) -> Column:
    """Sum of deltas as BIGINT; beyond 64 bits it wraps, or is NULL on request."""
    if overflow not in (WRAP, NULL):
        raise ValueError(f"unknown overflow {overflow!r}")
    total = exact_sum(delta)
    return wrap_int64(total) if overflow == WRAP else total.try_cast("bigint")


def _delta() -> Column:
    return F.when(F.col("metric_type") == COUNTER, F.col("delta"))


def _value() -> Column:
    return F.when(F.col("metric_type") == GAUGE, F.col("value"))


def fold_updates(updates: DataFrame, overflow: str = WRAP) -> DataFrame:
    """State of accepted updates: counter sums, last gauges and first-seen times.

    Works on streams too. The value field of the other type is ignored.
    """
    folded = updates.groupBy(*STATE_KEY).agg(
        F.max_by(_value(), "seq").alias("gauge_value"),
        _counter_total(_delta(), overflow).alias("counter_value"),
        F.min("ts").alias("first_seen"),
        F.max(F.when(F.col("metric_type") == GAUGE, F.col("seq"))).alias("gauge_seq"),
    )
    return folded.select(*STATE.fieldNames())


def sum_counters(updates: DataFrame, overflow: str = WRAP) -> DataFrame:
    return (
        updates.where(F.col("metric_type") == COUNTER)
        .groupBy("name")
        .agg(_counter_total(F.col("delta"), overflow).alias("counter_value"))
    )


def last_gauges(updates: DataFrame) -> DataFrame:
    return (
        updates.where(F.col("metric_type") == GAUGE)
        .groupBy("name")
        .agg(F.max_by("value", "seq").alias("gauge_value"))
    )


def first_seen(updates: DataFrame) -> DataFrame:
    return updates.groupBy(*STATE_KEY).agg(F.min("ts").alias("first_seen"))


def merge_states(*states: DataFrame, overflow: str = WRAP) -> DataFrame:
    """One state out of several: counters add, the gauge that arrived last wins,
    first-seen stays.

    Every side holds one row per key, so this is a union and one aggregation rather
    than joins. Arrival order decides, not the order of arguments; only gauges without
    one, or with the same, are taken from the later argument.
    """
    aged = [s.select(*STATE.fieldNames(), F.lit(i).alias("_age")) for i, s in enumerate(states)]
    both = functools.reduce(DataFrame.unionByName, aged)
    return merge_rows(both, F.col("_age"), Decimal(len(states)), overflow)


def merge_rows(rows: DataFrame, age: Column, ages: Decimal, overflow: str = WRAP) -> DataFrame:
    """State rows of any number per key into one each; ``age``, from 0 and below ``ages``,
    decides between gauges of the same arrival order."""
    order = F.coalesce("gauge_seq", F.lit(Decimal(-1))) * F.lit(ages) + age
    held = F.when(F.col("metric_type") == GAUGE, order.cast(SEQ))
    merged = rows.groupBy(*STATE_KEY).agg(
        F.max_by("gauge_value", held).alias("gauge_value"),
        _counter_total(F.col("counter_value"), overflow).alias("counter_value"),
        F.min("first_seen").alias("first_seen"),
        F.max("gauge_seq").alias("gauge_seq"),
    )
    return merged.select(*STATE.fieldNames())


def latest_per_name(updates: DataFrame, *keys: str) -> DataFrame:
    """Newest record per name, whatever its type; optionally per further keys.

    Records are thinned to the newest per type first, with fixed-width buffers; the
    type as text is compared only among those few.
    """
    by_type = updates.groupBy(*keys, "name", "metric_type").agg(
        F.max_by("delta", "seq").alias("delta"),
        F.max_by("value", "seq").alias("value"),
        F.max("seq").alias("seq"),
    )
    newest = by_type.groupBy(*keys, "name").agg(
        F.max_by(F.struct("metric_type", "delta", "value", "seq"), "seq").alias("_newest")
    )
    return newest.select(*keys, "name", "_newest.*")


def newest_rows(rows: DataFrame, key: str = "name", order: str = "seq") -> DataFrame:
    """Entire newest row per key, for rows of any layout.

    Spark limits each task to one row per key before the shuffle.
    """
    window = Window.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
