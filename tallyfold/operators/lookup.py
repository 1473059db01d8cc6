"""Reading state: by type, by key, in bulk, and as a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.classes import is_known_type
from tallyfold.functions.numbers import value_text
from tallyfold.functions.render import update_json
from tallyfold.schema import COUNTER, GAUGE, STATE_KEY


def all_gauges(state: DataFrame) -> DataFrame:
    return state.where(F.col("metric_type") == GAUGE).select("name", "gauge_value")


def all_counters(state: DataFrame) -> DataFrame:
    return state.where(F.col("metric_type") == COUNTER).select("name", "counter_value")


def point_lookup(state: DataFrame, metric_type: str, name: str) -> DataFrame:
    """At most one row; both conditions reach the scan of stored state."""
    return state.where((F.col("name") == name) & (F.col("metric_type") == metric_type))


def frequent_keys(requests: DataFrame, most: int = 256, share: int = 1000) -> list[str]:
    """Keys (see ``_key_text``) that more than one in ``share`` requests asks for.

    A sketch of ``most`` counters per task finds them, merged without a shuffle of requests;
    a key of such a share cannot hide from it.
    """
    kept = max(most, 10 * share)
    found = requests.agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k({_KEY_TEXT}, {most}, {kept})").alias("top")
    ).first()
    return [row["item"] for row in found["top"] or [] if row["count"] * share > found["n"]]


# One text per key, null where a part of it is: such requests match no state.
_KEY_TEXT = "concat(length(name), ':', name, metric_type)"


def answer_lookups(requests: DataFrame, state: DataFrame, most: int = 256, share: int = 1000) -> DataFrame:
    """``requests(name, metric_type, ...)`` with value, text, JSON reply and ``http_status``.

    A known key is 200, a missing one 404; an unknown type is 200 without value, its
    request echoed. Requests for frequent keys stay where they are and meet a broadcast of
    those at most ``most`` state rows, however many requests there are and whatever other
    columns they have; all others are one plain join, in which a key has few rows.
    """
    frequent = [] if requests.isStreaming else frequent_keys(requests, most, share)
    values = state.select(*STATE_KEY, "counter_value", "gauge_value", F.lit(True).alias("_found"))
    if frequent:
        hot = F.coalesce(F.expr(_KEY_TEXT).isin(frequent), F.lit(False))
        few = F.broadcast(values.where(hot))
        answered = requests.where(hot).join(few, STATE_KEY, "left").unionByName(
            requests.where(~hot).join(values, STATE_KEY, "left")
        )
    else:
        answered = requests.join(values, STATE_KEY, "left")
    known = is_known_type(F.col("metric_type"))
    status = F.when(known & F.col("_found").isNull(), 404).otherwise(200)
    text = value_text(F.col("metric_type"), F.col("counter_value"), F.col("gauge_value"))
    reply = update_json(
        F.col("name"), F.col("metric_type"), F.col("counter_value"), F.col("gauge_value")
    )
    return answered.select(
        *requests.columns,
        "counter_value",
        "gauge_value",
        F.when(status == 200, text).alias("value_text"),
        F.when(status == 200, reply).alias("reply"),
        status.alias("http_status"),
    )


def listing(state: DataFrame) -> DataFrame:
    """Counters, then gauges, each by name, with the value as text."""
    section = F.when(F.col("metric_type") == COUNTER, 1).otherwise(2)
    rows = state.where(is_known_type(F.col("metric_type"))).select(
        section.alias("section"),
        "name",
        value_text(F.col("metric_type"), F.col("counter_value"), F.col("gauge_value")).alias(
            "value_text"
        ),
    )
    return rows.orderBy("section", "name")
