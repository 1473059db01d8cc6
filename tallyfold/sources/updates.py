"""Updates from JSON bodies and from path text.

Bodies stay one row per request until :func:`explode_batches`, so a batch is
judged without a shuffle, in batch jobs and on streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numbers import parse_float64, parse_int64
from tallyfold.functions.ordering import seq_of
from tallyfold.schema import COUNTER, GAUGE

_TYPED = "struct<id string, type string, delta bigint, value double, hash string>"
_TAGGED = "struct<id variant, type variant, hash variant>"
_FIELD_NAMES = ("name", "metric_type", "delta", "value", "hash")
_PARSE_OPTIONS = {
    "columnNameOfCorruptRecord": "_bad",
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
}


_KEYS = "id|type|delta|value|hash"
# A key in some other case; inside a string its quotes would be escaped.
_OTHER_CASE = rf'(?<!\\)"(?!(?:{_KEYS})")(?i:{_KEYS})"\s*:'


def _lower_keys(text: Column) -> Column:
    """Keys match in any case: those of a record are put in lower case first."""
    lowered = text
    for key in _KEYS.split("|"):
        lowered = F.regexp_replace(lowered, rf'(?<!\\)"(?i:{key})"(?=\s*:)', f'"{key}"')
    return F.when(text.rlike(_OTHER_CASE), lowered).otherwise(text)


def _with_text(requests: DataFrame, body: str) -> DataFrame:
    """Adds ``_text``: the body as the only element of an array.

    The wrapping makes anything after the first JSON value an error, which a
    plain parse would skip.
    """
    inner = _lower_keys(F.coalesce(F.col(body), F.lit("")))
    return requests.withColumn("_text", F.concat(F.lit('{"items":['), inner, F.lit("]}")))


def _parsed(element: str) -> Column:
    return F.from_json("_text", f"items array<{element}>, _bad string", _PARSE_OPTIONS)


def _maybe_not_text(item: Column) -> Column:
    """Whether a text field reads like a number, a boolean or a nested value.

    Spark turns those into text without complaint. Real text may look the same, so
    this only selects the bodies worth a second parse; comparing first characters
    costs a fraction of a pattern match.
    """

    def suspicious(field: Column) -> Column:
        return F.coalesce(
            ((field >= "-") & (field < ":"))
            | field.startswith("{")
            | field.startswith("[")
            | field.isin("true", "false"),
            F.lit(False),
        )

    return suspicious(item["id"]) | suspicious(item["type"]) | suspicious(item["hash"])


def _not_text(tagged: Column) -> Column:
    """Whether a field that must be text holds another kind of JSON value."""

    def wrong(field: Column) -> Column:
        return F.coalesce(~F.schema_of_variant(field).isin("STRING", "VOID"), F.lit(False))

    return wrong(tagged["id"]) | wrong(tagged["type"]) | wrong(tagged["hash"])


# A bracket that could close the wrapping, other than the wrapping's own.
_EARLY_END = r"\]\s*[,}](?!\z)"
_STRINGS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _leaves_wrapping(text: Column) -> Column:
    """Whether a body closes the wrapping and goes on behind it, be it with another member
    or with a value of its own. Brackets outside strings are followed only where one of
    them could do so."""
    brackets = F.regexp_extract_all(F.regexp_replace(text, _STRINGS, ""), F.lit(r"[\[\]{}]"), F.lit(0))
    inner = F.slice(brackets, F.lit(3), F.greatest(F.size(brackets) - 4, F.lit(0)))
    lowest = F.aggregate(
        inner,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low")),
        lambda at, bracket: _step(at, F.when(bracket.isin("[", "{"), 1).otherwise(-1)),
        lambda at: at["low"],
    )
    return F.when(text.rlike(_EARLY_END), lowest < 0).otherwise(False)


def _step(at: Column, change: Column) -> Column:
    return F.struct((at["depth"] + change).alias("depth"), F.least(at["low"], at["depth"] + change).alias("low"))


def _once(parsed: DataFrame, columns: list[str], *outputs: Column) -> DataFrame:
    """Add ``outputs``, each worked out once per row.

    Filters that callers put on the result would otherwise be pushed below the
    projection and parse every body again; they do not pass a generator.
    """
    return parsed.select(*columns, F.inline(F.array(F.struct(*outputs))))


def _fields(item: Column) -> list[Column]:
    """Absent text is empty, as in a zero record; absent numbers stay NULL."""
    return [
        F.coalesce(item["id"], F.lit("")).alias("name"),
        F.coalesce(item["type"], F.lit("")).alias("metric_type"),
        item["delta"].alias("delta"),
        item["value"].alias("value"),
    ]


def _malformed(found: Column, tagged: Column) -> Column:
    """Whether a body parsed as ``_json`` with elements ``found`` must be refused.

    JSON has no infinity, so an infinite value was a number out of range. The
    stricter second parse ``tagged`` runs for suspicious bodies only.
    """
    def has(infinity: float) -> Column:
        return F.coalesce(F.array_contains(found["value"], infinity), F.lit(False))

    return (
        F.col("_json._bad").isNotNull()
        | _leaves_wrapping(F.col("_text"))
        | F.coalesce(F.size("_json.items") != 1, F.lit(True))
        | has(float("inf"))
        | has(float("-inf"))
        | F.when(
            F.exists(found, _maybe_not_text), F.coalesce(F.exists(tagged, _not_text), F.lit(False))
        ).otherwise(False)
    )


def parse_updates(requests: DataFrame, body: str = "body") -> DataFrame:
    """One update per body: adds ``name, metric_type, delta, value, hash, malformed``.

    A number in a text field, text in a number field, a fraction in ``delta``, a
    number out of range or anything after the value makes the body malformed.
    Key names are matched in any case.
    """
    parsed = _with_text(requests, body).withColumn("_json", _parsed(_TYPED))
    found = F.col("_json.items")
    malformed = _malformed(found, _parsed(_TAGGED)["items"])
    judged = parsed.withColumn("malformed", malformed)
    item = F.get(found, 0)
    fields = [*_fields(item), F.coalesce(item["hash"], F.lit("")).alias("hash")]
    kept = [F.when(~F.col("malformed"), f).alias(n) for f, n in zip(fields, _FIELD_NAMES)]
    return _once(judged, requests.columns, *kept, F.col("malformed"))


def parse_batches(requests: DataFrame, body: str = "body") -> DataFrame:
    """One ordered list of updates per body: adds ``items`` and ``malformed``.

    One mistyped element makes the entire body malformed; ``null`` is an empty list.
    """
    parsed = _with_text(requests, body).withColumn("_json", _parsed(f"array<{_TYPED}>"))
    found = F.get("_json.items", 0)
    malformed = _malformed(found, F.get(_parsed(f"array<{_TAGGED}>")["items"], 0))
    judged = parsed.withColumn("malformed", malformed)
    items = F.coalesce(found, F.array().cast(f"array<{_TYPED}>"))
    return _once(
        judged,
        requests.columns,
        F.when(~F.col("malformed"), items).alias("items"),
        F.col("malformed"),
    )


def explode_batches(batches: DataFrame, items: str = "items") -> DataFrame:
    """Update rows of ``batches(batch_id, ts, client, items)`` in array order."""
    # Over a bare column Spark would add a filter on its size and push that down.
    present = F.coalesce(F.col(items), F.array().cast(batches.schema[items].dataType))
    rows = batches.select(
        "batch_id", "ts", "client", F.posexplode(present).alias("pos", "_item")
    )
    pos = F.col("pos").cast("bigint")
    return rows.select(
        seq_of(F.col("batch_id"), pos).alias("seq"),
        "batch_id",
        pos.alias("pos"),
        "ts",
        "client",
        F.lit("batch").alias("form"),
        *_fields(F.col("_item")),
    )


def parse_paths(requests: DataFrame, path: str = "path") -> DataFrame:
    """Updates from ``/update/{type}/{id}/{value}``; other paths are malformed."""
    text = F.coalesce(F.col(path), F.lit(""))
    split = requests.withColumn("_parts", F.split(text, "/", 7))
    parts, length = F.col("_parts"), F.size("_parts")
    # One closing slash is allowed: it leaves an empty sixth part.
    routed = (
        (F.get(parts, 0) == "")
        & (F.get(parts, 1) == "update")
        & ((length == 5) | ((length == 6) & (F.get(parts, 5) == "")))
    )

    def part(position: int) -> Column:
        return F.when(routed, F.get(parts, position)).otherwise("")

    fields = split.select(
        *requests.columns,
        part(3).alias("name"),
        part(2).alias("metric_type"),
        part(4).alias("_value"),
        (~routed).alias("malformed"),
    )
    is_counter, is_gauge = F.col("metric_type") == COUNTER, F.col("metric_type") == GAUGE
    return _once(
        fields,
        [*requests.columns, "name", "metric_type"],
        F.when(is_counter, parse_int64(F.col("_value"))).alias("delta"),
        F.when(is_gauge, parse_float64(F.col("_value"))).alias("value"),
        F.col("malformed"),
    )
