"""The class of one update and what it means for its request."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.schema import COUNTER, GAUGE, INT32_MAX, INT32_MIN, MAX_NAME_LENGTH, METRIC_TYPES

OK = "ok"
UNKNOWN_TYPE = "unknown_type"
MEMORY, TABLE = "memory", "table"


def is_known_type(metric_type: Column) -> Column:
    return F.coalesce(metric_type.isin(*METRIC_TYPES), F.lit(False))


def _stops(
    name: Column, metric_type: Column, delta: Column, value: Column, store: str
) -> list[tuple[Column, str]]:
    """What stops a batch, in the order it is tested, with the class it gives."""
    if store not in (MEMORY, TABLE):
        raise ValueError(f"unknown store {store!r}")
    is_counter, is_gauge = metric_type == COUNTER, metric_type == GAUGE
    stops = [(is_counter & delta.isNull(), "null_delta"), (is_gauge & value.isNull(), "null_value")]
    if store == TABLE:
        too_long = is_known_type(metric_type) & (F.length(name) > MAX_NAME_LENGTH)
        out_of_range = is_counter & ~delta.between(INT32_MIN, INT32_MAX)
        stops += [(too_long, "name_too_long"), (out_of_range, "delta_range")]
    return stops


# Only in the path form a missing number means text that did not parse.
_PATH_CLASS = {"null_delta": "bad_delta", "null_value": "bad_value"}
# Every class an update can have.
CLASSES = (
    OK, UNKNOWN_TYPE, "missing_id", "null_delta", "null_value", "bad_delta", "bad_value",
    "name_too_long", "delta_range",
)


def update_class(
    name: Column,
    metric_type: Column,
    delta: Column,
    value: Column,
    form: Column,
    store: str = MEMORY,
) -> Column:
    """Why an update is refused, or ``ok``.

    Only the path form refuses an empty id. The table store adds the limits of its
    columns.
    """
    is_path = F.coalesce(form == "path", F.lit(False))
    judged = F.when(is_path & (F.coalesce(name, F.lit("")) == ""), "missing_id")
    for stops, class_ in _stops(name, metric_type, delta, value, store):
        on_path = _PATH_CLASS.get(class_, class_)
        judged = judged.when(stops, F.when(is_path, on_path).otherwise(class_))
    return judged.when(~is_known_type(metric_type), UNKNOWN_TYPE).otherwise(OK)


def stops_batch(item: Column, store: str = MEMORY) -> Column:
    """``fails_batch`` of one list element, without spelling out its class.

    It runs inside ``transform`` and ``exists``, which are interpreted, so it is a
    plain condition.
    """
    conditions = _stops(item["id"], item["type"], item["delta"], item["value"], store)
    return F.coalesce(functools.reduce(Column.__or__, [stops for stops, _ in conditions]), F.lit(False))


def fails_batch(class_: Column) -> Column:
    """Whether an update of this class stops its batch; unknown types are only skipped."""
    return ~class_.isin(OK, UNKNOWN_TYPE)
