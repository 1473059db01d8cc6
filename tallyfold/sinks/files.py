"""Outgoing bodies on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bodies(batches: DataFrame, path: str, body: str = "body", gzip: bool = True) -> None:
    """One body per line, compressed as bodies are when sent."""
    writer = batches.select(batches[body].alias("value")).write.mode("overwrite")
    writer.option("compression", "gzip" if gzip else "none").text(path)
