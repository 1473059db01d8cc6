"""Arrival order and times."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.schema import BATCH_STRIDE, SEQ

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def seq_of(batch_id: Column, pos: Column) -> Column:
    """One DECIMAL(38,0) that sorts like ``(batch_id, pos)``, for any BIGINT and array.

    A number as ordering key keeps ``max_by`` in the hash aggregate; a struct key
    would force sorting.
    """
    wide = batch_id.cast("decimal(20,0)") * F.lit(Decimal(BATCH_STRIDE)) + pos
    return wide.cast(SEQ)


def _is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def _zoneless_seconds(name: str) -> Column:
    """Seconds since the epoch with microseconds, independent of the session zone.

    Subtracting two zone-less times stays zone-less; ``timestampdiff`` would not.
    """
    return F.expr(f"cast(cast(`{name}` - {_EPOCH_NTZ} as interval second) as decimal(20,6))")


def unix_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since the epoch; a zone-less time is taken as UTC."""
    if _is_ntz(df, name):
        return F.floor(_zoneless_seconds(name)).cast("bigint")
    return F.unix_seconds(F.col(name))
