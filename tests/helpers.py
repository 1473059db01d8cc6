"""Small builders for update rows and states."""

import datetime
from decimal import Decimal

from tallyfold.schema import BATCH_STRIDE, STATE

UPDATE = (
    "seq decimal(38,0), batch_id bigint, pos bigint, ts timestamp_ntz, client string, form string, "
    "name string, metric_type string, delta bigint, value double"
)
T0 = datetime.datetime(2024, 1, 1)


def updates(spark, rows, form="batch"):
    """Rows are ``(batch_id, pos, name, type, delta, value)``."""
    full = [
        (Decimal(b * BATCH_STRIDE + p), b, p, T0 + datetime.timedelta(seconds=(b * 60 + p) % 10**8), f"10.0.0.{b}", form,
         name, kind, delta, value)
        for b, p, name, kind, delta, value in rows
    ]
    return spark.createDataFrame(full, UPDATE)


def one_by_one(spark, rows, form="batch"):
    """Rows are ``(name, type, delta, value)``, each its own batch."""
    return updates(spark, [(i, 0, *row) for i, row in enumerate(rows)], form)


def state(spark, rows):
    """Rows are ``(name, type, gauge, counter)`` and perhaps the gauge's ``seq``."""
    full = [(*row[:4], T0, Decimal(row[4]) if len(row) > 4 else None) for row in rows]
    return spark.createDataFrame(full, STATE)


def values(frame):
    return {
        (r.name, r.metric_type): r.counter_value if r.metric_type == "counter" else r.gauge_value
        for r in frame.collect()
    }
