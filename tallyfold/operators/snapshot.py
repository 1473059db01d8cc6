"""State as snapshot documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numbers import json_number
from tallyfold.functions.render import json_text
from tallyfold.schema import COUNTER, GAUGE


def _is_finite() -> Column:
    return ~F.isnan("gauge_value") & (F.abs("gauge_value") < float("inf"))


def snapshot_documents(state: DataFrame) -> DataFrame:
    """``(counters, gauges, skipped)``, one document per state row.

    A document names one metric, so nothing is gathered and the layout does not depend
    on the size; together the documents hold every key. JSON has no NaN or infinity and
    no NULL key: such rows give an empty document with ``skipped`` 1.
    """
    kept = F.col("name").isNotNull()
    counter = kept & (F.col("metric_type") == COUNTER)
    gauge = kept & (F.col("metric_type") == GAUGE) & F.coalesce(_is_finite(), F.lit(True))
    known = F.col("metric_type").isin(COUNTER, GAUGE)
    return state.where(known).select(
        _entry(counter, "counter_value", "bigint").alias("counters"),
        _entry(gauge, "gauge_value", "double").alias("gauges"),
        F.when(counter | gauge, 0).otherwise(1).alias("skipped"),
    )


def _entry(condition: Column, value: str, kind: str) -> Column:
    entry = F.map_from_arrays(F.array(F.coalesce("name", F.lit(""))), F.array(value))
    return F.when(condition, entry).otherwise(F.create_map().cast(f"map<string, {kind}>"))


def document_lines(state: DataFrame) -> DataFrame:
    """The lines ``value`` of one indented document of all keys, in order.

    Sections and their frame are numbered, lines are sorted by section and name over all
    tasks, and only the last name of each section is known to all, as it takes no comma.
    What JSON has not is left out, as in ``snapshot_documents``.
    """
    counter = F.col("metric_type") == COUNTER
    gauge = (F.col("metric_type") == GAUGE) & F.coalesce(_is_finite(), F.lit(True))
    number = F.when(counter, F.col("counter_value").cast("string")).otherwise(json_number(F.col("gauge_value")))
    entries = state.where(F.col("name").isNotNull() & (counter | gauge)).select(
        F.when(counter, _COUNTERS).otherwise(_GAUGES).alias("section"),
        "name",
        F.concat(F.lit("\t\t"), json_text(F.col("name")), F.lit(": "), F.coalesce(number, F.lit("null"))).alias("value"),
    )
    last = entries.agg(
        *[F.max(F.when(F.col("section") == s, F.col("name"))).alias(f"last_{s}") for s in (_COUNTERS, _GAUGES)]
    )
    last_name = F.when(F.col("section") == _COUNTERS, last.select(f"last_{_COUNTERS}").scalar()).otherwise(
        last.select(f"last_{_GAUGES}").scalar()
    )
    comma = F.when(F.col("name") == last_name, "").otherwise(",")
    frame = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(None).cast("string").alias("name"), F.lit(v).alias("value")) for s, v in _FRAME])
    framing = state.sparkSession.range(1, numPartitions=1).select(F.inline(frame))
    lines = entries.withColumn("value", F.concat("value", comma)).unionByName(framing)
    return lines.orderBy("section", "name").select("value")


# Sections of the document in order; between them the lines that frame it.
_COUNTERS, _GAUGES = 2, 4
_FRAME = ((1, '{\n\t"counters": {'), (3, '\t},\n\t"gauges": {'), (5, "\t}\n}"))
