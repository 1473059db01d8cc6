"""Body digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def body_digest(body: Column, key: str) -> Column:
    """Hex SHA-256 of the decoded body followed by the key."""
    return F.sha2(F.concat(body.cast("binary"), F.lit(key).cast("binary")), 256)


def digest_matches(body: Column, key: str, header: Column) -> Column:
    """Whether the header carries the body's digest; without a key nothing is checked."""
    if not key:
        return F.lit(True)
    return body_digest(body, key) == F.coalesce(header, F.lit(""))
