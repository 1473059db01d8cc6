"""Audit events of a stream of judged batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyfold.sinks.audit_log import Sink, fan_out


def run_audit(events: DataFrame, sinks: Sequence[Sink], checkpoint: str) -> StreamingQuery:
    """Deliver every event to every sink, over what has arrived so far."""
    return (
        events.writeStream.foreachBatch(fan_out(sinks))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
