"""Helpers shared by the operators of this package."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import new_work_dir

# Fixed value: a word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def cut(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back.

    Later steps start from these files, so a lost executor costs a read and not
    the whole history, and nothing above is computed twice.
    """
    spark: SparkSession = frame.sparkSession
    path = new_work_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Taking out what lies between words is many times as fast as extracting them."""
    return F.array_remove(F.split(text, BETWEEN_WORDS), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose helper columns, which begin with ``_``, meet none of its input:
    such columns of the input bear other names meanwhile, and keep their values."""

    @functools.wraps(operator)
    def run(frame: DataFrame, *args, **kwargs) -> DataFrame:
        clashing = [c for c in frame.columns if c.startswith("_")]
        used = {c.lower() for c in frame.columns}
        free = (name for name in (f"aside{i}" for i in itertools.count()) if name not in used)
        names = dict(zip(clashing, free))
        result = operator(frame.withColumnsRenamed(names), *args, **kwargs) if names else operator(frame, *args, **kwargs)
        return result.withColumnsRenamed({v: k for k, v in names.items()})

    return run
