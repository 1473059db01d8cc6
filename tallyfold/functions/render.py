"""JSON text of updates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.functions.numbers import json_number

# What a JSON string must or should not hold as it is: the last five for HTML's sake.
_ESCAPED = "[\\x00-\\x1F\"\\\\<>&\u2028\u2029]"


def json_text(text: Column) -> Column:
    """A JSON string; NULL counts as empty, and what HTML minds is escaped. Most texts
    hold nothing to escape and are only quoted."""
    plain = F.coalesce(text, F.lit(""))
    listed = F.to_json(F.array(plain))
    escaped = F.substring(listed, F.lit(2), F.length(listed) - 2)
    for char in "<>&\u2028\u2029":
        escaped = F.replace(escaped, F.lit(char), F.lit(f"\\u{ord(char):04x}"))
    return F.when(plain.rlike(_ESCAPED), escaped).otherwise(F.concat(F.lit('"'), plain, F.lit('"')))


def update_json(
    name: Column, metric_type: Column, delta: Column, value: Column, hash_: Column | None = None
) -> Column:
    """One update as JSON, leaving out ``delta``, ``value`` and ``hash`` when absent.

    An empty hash counts as absent. A value that JSON has not gives NULL.
    """
    hash_ = F.lit(None).cast("string") if hash_ is None else F.nullif(hash_, F.lit(""))

    def member(key: str, present: Column, text: Column) -> Column:
        return F.when(present.isNull(), "").otherwise(F.concat(F.lit(f',"{key}":'), text))

    return F.concat(
        F.lit('{"id":'),
        json_text(name),
        F.lit(',"type":'),
        json_text(metric_type),
        member("delta", delta, delta.cast("string")),
        member("value", value, json_number(value)),
        member("hash", hash_, json_text(hash_)),
        F.lit("}"),
    )


def json_list(records: Column) -> Column:
    """A JSON array of record texts; NULL if one of them is."""
    whole = F.concat(F.lit("["), F.array_join(records, ","), F.lit("]"))
    return F.when(~F.exists(records, lambda r: r.isNull()), whole)
