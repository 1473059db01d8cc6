"""Continuous state in the stream's own store, delivered as the keys that changed.

The state of every key lies in Spark's state store and its checkpoint; nothing outside is
read to go on. Each micro-batch delivers the keys it changed, with their new state, to a
folder of its epoch, which a replay replaces. So an interval costs what changed. From time
to time a full state is written beside them, merged from the last full one and the changes
since; folders of earlier epochs are no longer read then and may be removed by any job.

A full state counts only once a later epoch stands beside it: until then it may be half
written, and the changes it was made from are still there.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyfold.schema import COUNTER, STATE, STATE_KEY
from tallyfold.streaming.state import continuous_state

RESTORED = -1  # the epoch of what was there before the stream
_VALUES = [c for c in STATE.fieldNames() if c not in STATE_KEY]
_CHANGES = T.StructType([*STATE.fields, T.StructField("full", T.BooleanType()), T.StructField("epoch", T.LongType())])


def rocksdb_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose streams keep their state in RocksDB."""
    session = spark.newSession()
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


class _KeyState(StatefulProcessor):
    """One key's state: the newest gauge, the running sum, the first time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", T.StructType([STATE[c] for c in _VALUES]))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState[_VALUES].itertuples(index=False):
            self._held.update(tuple(None if pd.isna(v) else v for v in self._typed(row)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        gauge, total, first, seq = self._held.get() if self._held.exists() else (None,) * 4
        counter = key[1] == COUNTER
        for batch in rows:
            seen = batch["ts"].min().to_pydatetime()
            first = seen if first is None else min(first, seen)
            if counter:
                total = (total or 0) + sum(map(int, batch["delta"]))
            else:
                newest = batch.loc[batch["seq"].map(Decimal).idxmax()]
                if seq is None or newest["seq"] > seq:
                    gauge, seq = float(newest["value"]), newest["seq"]
        if counter:  # 64 bits, as the in-memory store counts
            total = (total + (1 << 63)) % (1 << 64) - (1 << 63)
        self._held.update((gauge, total, first, seq))
        yield pd.DataFrame([(*key, gauge, total, first, seq)], columns=STATE.fieldNames(), dtype=object)

    @staticmethod
    def _typed(row) -> tuple:
        gauge, total, first, seq = row
        return gauge, None if pd.isna(total) else int(total), first if pd.isna(first) else first.to_pydatetime(), seq


def resumed_state(updates: DataFrame, restored: DataFrame | None = None) -> DataFrame:
    """State over a stream of accepted updates, begun from ``restored`` (rows of state, or
    None). Emits the keys of each micro-batch. Needs the RocksDB provider.

    ``restored`` counts when the query starts for the first time; afterwards its checkpoint
    has it. A key's rows of a micro-batch go through one task, in bounded pieces.
    """
    # Decimals keep all digits of a delta where others of its batch are null.
    rows = updates.select(*STATE_KEY, "seq", "ts", F.col("delta").cast("decimal(20,0)").alias("delta"), "value")
    initial = None
    if restored is not None:
        exact = F.col("counter_value").cast("decimal(20,0)").alias("counter_value")
        initial = restored.select(*[exact if c == "counter_value" else F.col(c) for c in STATE.fieldNames()]).groupBy(*STATE_KEY)
    return rows.groupBy(*STATE_KEY).transformWithStateInPandas(
        _KeyState(), outputStructType=STATE, outputMode="update", timeMode="none", initialState=initial
    )


def _write(state: DataFrame, path: str, full: bool, epoch: int) -> None:
    folder = f"{path}/full={str(full).lower()}/epoch={epoch}"
    state.select(*STATE.fieldNames()).write.mode("overwrite").parquet(folder)


def run_changes(
    state: DataFrame, path: str, checkpoint: str, full_every: int = 0, interval_seconds: int = 0
) -> StreamingQuery:
    """Deliver a stream of state in output mode update; every so manieth epoch also the
    full state (0: never)."""

    def deliver(changed: DataFrame, epoch: int) -> None:
        _write(changed, path, False, epoch)
        if full_every and epoch % full_every == full_every - 1:
            _write(read_changes(changed.sparkSession, path), path, True, epoch)

    return (
        state.writeStream.outputMode("update")
        .foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": f"{interval_seconds} seconds"} if interval_seconds else {"availableNow": True}))
        .start()
    )


def run_state_changes(updates: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Fold accepted updates forever; see ``run_changes``."""
    return run_changes(continuous_state(updates), path, checkpoint, **options)


def run_resumed_changes(
    updates: DataFrame, path: str, checkpoint: str, restored: DataFrame | None = None, **options
) -> StreamingQuery:
    """The same from restored state. Its keys are delivered first, under an epoch of their
    own: they may never change."""
    if restored is not None:
        _write(restored, path, False, RESTORED)
    return run_changes(resumed_state(updates, restored), path, checkpoint, **options)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The state now: for every key the row of its newest epoch since the last full state."""
    rows = since_full(spark.read.schema(_CHANGES).parquet(path))
    return rows.groupBy(*STATE_KEY).agg(*[F.max_by(c, "epoch").alias(c) for c in _VALUES])


def since_full(rows: DataFrame) -> DataFrame:
    """The rows that count of folders ``full`` and ``epoch``: the last full state that is
    surely whole, and what came after it."""
    # Folder names answer this; no file is opened for it.
    last = rows.where(~F.col("full")).agg(F.max("epoch")).first()[0]
    full = rows.where(F.col("full") & (F.col("epoch") < F.lit(last))).agg(F.max("epoch")).first()[0]
    if full is not None:
        since = ~F.col("full") & (F.col("epoch") > full)
        return rows.where(since | (F.col("full") & (F.col("epoch") == full)))
    return rows.where(~F.col("full"))
