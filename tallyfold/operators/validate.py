"""Judging updates and batches.

An update row is ``(seq, batch_id, pos, ts, client, form, name, metric_type,
delta, value)``. A batch is one request body, so a group of one
batch is bounded whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.classes import (
    CLASSES,
    MEMORY,
    OK,
    TABLE,
    fails_batch,
    is_known_type,
    stops_batch,
    update_class,
)
from tallyfold.functions.digest import digest_matches
from tallyfold.schema import COUNTER, GAUGE, INT32_MAX, INT32_MIN, MAX_NAME_LENGTH
from tallyfold.sources.updates import explode_batches

REJECT_BATCH, APPLY_PREFIX = "reject_batch", "apply_prefix"


def classify(updates: DataFrame, store: str = MEMORY) -> DataFrame:
    """Adds ``update_class``."""
    return updates.withColumn(
        "update_class",
        update_class(
            F.col("name"), F.col("metric_type"), F.col("delta"), F.col("value"), F.col("form"), store
        ),
    )


def quarantine(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and refused rows with their reason."""
    return judged.where(F.col("update_class") == OK), judged.where(F.col("update_class") != OK)


def write_judged(judged: DataFrame, path: str) -> dict[str, int]:
    """Both sides of the split in one pass, as folders ``side=accepted|refused``.

    Returns the updates of each class. The tasks that write count them as the rows flow, so
    they take no second pass; a task that runs again counts once.
    """
    side = F.when(F.col("update_class") == OK, "accepted").otherwise("refused")
    seen = Observation()
    counted = judged.observe(seen, *[F.count_if(F.col("update_class") == c).alias(c) for c in CLASSES])
    counted.withColumn("side", side).write.mode("overwrite").partitionBy("side").parquet(path)
    return {class_: n for class_, n in seen.get.items() if n}


def class_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``(update_class, updates)`` of what ``write_judged`` counted."""
    return spark.createDataFrame(list(counts.items()), "update_class string, updates bigint")


def reject_bad_batches(judged: DataFrame) -> DataFrame:
    """Rows of batches without any bad row.

    Only ids of bad batches go to the small side; the optimizer broadcasts them
    when their measured size allows and otherwise joins by ``batch_id``.
    """
    bad = judged.where(fails_batch(F.col("update_class"))).select("batch_id").distinct()
    return judged.join(bad, "batch_id", "left_anti").select(*judged.columns)


def apply_prefix(judged: DataFrame) -> DataFrame:
    """Rows that come before the first bad row of their batch."""
    first_bad = (
        judged.where(fails_batch(F.col("update_class")))
        .groupBy("batch_id")
        .agg(F.min("pos").alias("_first_bad"))
    )
    return (
        judged.join(first_bad, "batch_id", "left")
        .where(F.col("_first_bad").isNull() | (F.col("pos") < F.col("_first_bad")))
        .select(*judged.columns)
    )


def skip_unknown_types(judged: DataFrame) -> DataFrame:
    """Unknown types are ignored in a batch, once the batch has been judged."""
    return judged.where(is_known_type(F.col("metric_type")))


def accepted_updates(
    updates: DataFrame, on_invalid: str = REJECT_BATCH, store: str = MEMORY
) -> DataFrame:
    """The rows that change state, for batches already split into rows."""
    judged = classify(updates, store)
    if on_invalid == REJECT_BATCH:
        kept = reject_bad_batches(judged)
    elif on_invalid == APPLY_PREFIX:
        kept = apply_prefix(judged)
    else:
        raise ValueError(f"unknown on_invalid {on_invalid!r}")
    return skip_unknown_types(kept)


def judge_batches(
    batches: DataFrame,
    on_invalid: str = REJECT_BATCH,
    store: str = MEMORY,
    key: str = "",
    body: str = "body",
    digest: str = "digest",
) -> DataFrame:
    """Verdict, outcome and surviving items of batches kept as one row per body.

    ``batches`` comes from ``parse_batches``. Adds ``http_status``, ``applied``,
    ``audit_ids`` (NULL unless accepted) and replaces ``items`` by those the store
    goes through. No shuffle: everything a verdict needs is in the row.
    """
    if on_invalid not in (REJECT_BATCH, APPLY_PREFIX):
        raise ValueError(f"unknown on_invalid {on_invalid!r}")

    first_bad = F.array_position(
        F.transform("items", lambda item: stops_batch(item, store)), True
    )
    signed = digest_matches(F.col(body), key, F.col(digest)) if key else F.lit(True)
    judged = batches.withColumn("_first_bad", first_bad).withColumn("_signed", signed)

    refused = ~F.col("_signed") | F.col("malformed")
    clean = F.col("_first_bad") == 0
    status = (
        F.when(~F.col("_signed"), 400)
        .when(F.col("malformed"), 422)
        .when(~clean, 500)
        .otherwise(200)
    )
    empty = F.array().cast(batches.schema["items"].dataType)
    prefix = (
        empty
        if on_invalid == REJECT_BATCH
        else F.slice("items", F.lit(1), (F.col("_first_bad") - 1).cast("int"))
    )
    survivors = F.when(refused, empty).when(clean, F.col("items")).otherwise(prefix)
    return judged.select(
        *[c for c in batches.columns if c != "items"],
        status.alias("http_status"),
        survivors.alias("items"),
        F.when(
            ~refused & clean,
            F.transform("items", lambda item: F.coalesce(item["id"], F.lit(""))),
        ).alias("audit_ids"),
    ).withColumn("applied", F.exists("items", lambda item: is_known_type(item["type"])))


def applied_updates(judged: DataFrame) -> DataFrame:
    """Update rows of ``judge_batches`` that change state, in arrival order."""
    return skip_unknown_types(explode_batches(judged))


def single_outcomes(judged: DataFrame) -> DataFrame:
    """``http_status`` and ``applied`` of path and JSON requests with one update.

    A gauge sent as JSON is stored and still answered 500. The path form ignores
    what the store says, so a row the table refuses is answered 200.
    """
    class_, is_path = F.col("update_class"), F.col("form") == "path"
    malformed = F.col("malformed") if "malformed" in judged.columns else F.lit(False)
    applied = ~malformed & (class_ == OK)
    path_status = (
        F.when(malformed | (class_ == "missing_id"), 404)
        .when(class_.isin("bad_delta", "bad_value", "unknown_type"), 400)
        .otherwise(200)
    )
    json_status = (
        F.when(malformed, 422)
        .when(applied & (F.col("metric_type") == COUNTER), 200)
        .otherwise(500)
    )
    return judged.withColumn(
        "http_status", F.when(is_path, path_status).otherwise(json_status)
    ).withColumn("applied", applied)


def batch_outcomes(judged: DataFrame, on_invalid: str = REJECT_BATCH) -> DataFrame:
    """``(batch_id, http_status, applied)`` for batches already split into rows."""
    fails = fails_batch(F.col("update_class"))
    known = is_known_type(F.col("metric_type"))
    verdict = judged.groupBy("batch_id").agg(
        F.min(F.when(fails, F.col("pos"))).alias("_first_bad"),
        F.min(F.when(known & ~fails, F.col("pos"))).alias("_first_good"),
    )
    clean, some = F.col("_first_bad").isNull(), F.col("_first_good").isNotNull()
    applied = clean & some
    if on_invalid == APPLY_PREFIX:
        applied = some & (clean | (F.col("_first_good") < F.col("_first_bad")))
    return verdict.select(
        "batch_id", F.when(clean, 200).otherwise(500).alias("http_status"), applied.alias("applied")
    )


def outcome_report(outcomes: DataFrame) -> DataFrame:
    """Requests per form, status and effect."""
    return outcomes.groupBy("form", "http_status", "applied").agg(F.count("*").alias("requests"))


def state_violations(state: DataFrame) -> DataFrame:
    """``(name, metric_type, rule, rows)`` for every constraint a state table breaks.

    All rules are counted per key in one aggregation, so a key repeated very
    often is combined before the shuffle instead of being joined back to itself.
    """
    gauge, counter = F.col("gauge_value"), F.col("counter_value")
    type_ = F.col("metric_type")
    matching = ((type_ == GAUGE) & gauge.isNotNull() & counter.isNull()) | (
        (type_ == COUNTER) & counter.isNotNull() & gauge.isNull()
    )
    rules = {
        "name_missing": F.col("name").isNull(),
        "name_too_long": F.length("name") > MAX_NAME_LENGTH,
        "type_not_allowed": ~is_known_type(type_),
        "counter_out_of_int32": ~counter.between(INT32_MIN, INT32_MAX),
        "value_column_mismatch": ~F.coalesce(matching, F.lit(False)),
    }
    counted = state.groupBy("name", "metric_type").agg(
        F.count("*").alias("key_not_unique"),
        *[F.count_if(F.coalesce(broken, F.lit(False))).alias(rule) for rule, broken in rules.items()],
    )
    repeated = F.when(F.col("key_not_unique") > 1, F.col("key_not_unique")).otherwise(0)
    findings = F.array(
        *[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("rows")) for rule in rules],
        F.struct(F.lit("key_not_unique").alias("rule"), repeated.cast("bigint").alias("rows")),
    )
    return counted.select("name", "metric_type", F.inline(findings)).where(F.col("rows") > 0)


__all__ = [
    "APPLY_PREFIX",
    "MEMORY",
    "REJECT_BATCH",
    "TABLE",
    "accepted_updates",
    "applied_updates",
    "apply_prefix",
    "batch_outcomes",
    "class_counts",
    "classify",
    "judge_batches",
    "outcome_report",
    "quarantine",
    "reject_bad_batches",
    "single_outcomes",
    "skip_unknown_types",
    "state_violations",
    "write_judged",
]
