"""Snapshot documents ``{counters: {...}, gauges: {...}}`` into state rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.schema import COUNTER, GAUGE, SEQ, SNAPSHOT

# Lines of an indented document: how a section begins, one entry, and closing brackets.
_HEAD = r'^\s*"(counters|gauges)"\s*:\s*\{\s*$'
_ENTRY = r'^\s*("[^"\\]*+(?:\\.[^"\\]*+)*+")\s*:\s*(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|null)\s*,?\s*$'
_OTHER = r'^\s*(?:\{|\}\s*,?|"(?:counters|gauges)"\s*:\s*(?:\{\s*\}|null)\s*,?)?\s*$'


def read_snapshot(spark: SparkSession, path: str, one_per_line: bool = True) -> DataFrame:
    """State rows of every readable document under ``path``.

    A foreign snapshot is one indented document per file: pass
    ``one_per_line=False``. An empty or unreadable document yields no rows.
    """
    schema = T.StructType([*SNAPSHOT.fields, T.StructField("_bad", T.StringType())])
    documents = (
        spark.read.schema(schema)
        .option("multiLine", not one_per_line)
        .option("columnNameOfCorruptRecord", "_bad")
        .option("allowNonNumericNumbers", "false")
        .json(path)
    )
    return snapshot_rows(documents.where(F.col("_bad").isNull()).select("counters", "gauges"))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """State rows of one document of any size, indented with a line per entry, in one file
    or in files that give it in the order of their names.

    Lines are parsed where they lie, by tasks that each read a piece of a file; a line's
    section is that of the last head above it, by file, offset of the piece and order
    within it. Each section stands in the document once. Like a reader of the whole, it
    takes all or nothing: a line that is no entry of its section's type, or brackets that
    do not match, as in a document cut short, give no rows.
    """
    lines = spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line")
        ).alias("place"),
    )
    line, place = F.col("value"), F.col("place")
    section = F.regexp_extract(line, _HEAD, 1)
    brackets = F.when(line.rlike(r"\{\s*$"), 1).when(line.rlike(r"^\s*\}"), -1).otherwise(0)
    head = lines.agg(
        *[F.max(F.when(section == name, place)).alias(name) for name in ("counters", "gauges")],
        (F.sum(brackets) == 0).alias("whole"),
    )
    counters, gauges, whole = (head.select(c).scalar() for c in ("counters", "gauges", "whole"))
    in_counters = F.coalesce(place > counters, F.lit(False))
    in_gauges = F.coalesce(place > gauges, F.lit(False))
    nearest = F.when(in_counters & in_gauges, F.when(counters > gauges, COUNTER).otherwise(GAUGE))
    kind = F.coalesce(nearest, F.when(in_counters, COUNTER).when(in_gauges, GAUGE))
    text = F.regexp_extract(line, _ENTRY, 2)
    rows = lines.where(~line.rlike(_HEAD) & ~line.rlike(_OTHER)).select(
        F.get(
            F.from_json(F.concat(F.lit("["), F.regexp_extract(line, _ENTRY, 1), F.lit("]")), "array<string>"), F.lit(0)
        ).alias("name"),
        kind.alias("metric_type"),
        text.alias("text"),
    )
    gauge = F.when(F.col("metric_type") == GAUGE, F.col("text").try_cast("double"))
    rows = rows.withColumns(
        {
            "gauge_value": F.when(F.abs(gauge) < float("inf"), gauge),
            "counter_value": F.when(
                (F.col("metric_type") == COUNTER) & F.col("text").rlike("^-?[0-9]+$"), F.col("text").try_cast("bigint")
            ),
        }
    )
    known = F.col("name").isNotNull() & (
        (F.col("text") == "null") & F.col("metric_type").isNotNull()
        | F.coalesce(F.col("gauge_value").isNotNull() | F.col("counter_value").isNotNull(), F.lit(False))
    )
    bad = rows.agg(F.count_if(~F.coalesce(known, F.lit(False))).alias("bad")).scalar()
    return _as_state(rows.where(whole & (bad == 0)))


def snapshot_rows(documents: DataFrame) -> DataFrame:
    """One state row per map entry, from one pass over the documents."""
    none_double, none_long = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    entries = F.concat(
        F.coalesce(
            F.transform(
                F.map_entries("counters"),
                lambda e: F.struct(
                    e["key"].alias("name"),
                    F.lit(COUNTER).alias("metric_type"),
                    none_double.alias("gauge_value"),
                    e["value"].alias("counter_value"),
                ),
            ),
            F.array(),
        ),
        F.coalesce(
            F.transform(
                F.map_entries("gauges"),
                lambda e: F.struct(
                    e["key"].alias("name"),
                    F.lit(GAUGE).alias("metric_type"),
                    e["value"].alias("gauge_value"),
                    none_long.alias("counter_value"),
                ),
            ),
            F.array(),
        ),
    )
    return _as_state(documents.select(F.inline(entries)))


def _as_state(rows: DataFrame) -> DataFrame:
    """The document holds no times, so first_seen is unknown after a restore."""
    return rows.select(
        "name",
        "metric_type",
        "gauge_value",
        "counter_value",
        F.lit(None).cast("timestamp_ntz").alias("first_seen"),
        F.lit(None).cast(SEQ).alias("gauge_seq"),
    )
