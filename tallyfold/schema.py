"""Record layouts and the fixed values shared by all modules."""

from __future__ import annotations

from pyspark.sql import types as T

# They decide results and must not be tuned.
COUNTER = "counter"
GAUGE = "gauge"
METRIC_TYPES = (COUNTER, GAUGE)
MAX_NAME_LENGTH = 100
INT32_MIN, INT32_MAX = -(2**31), 2**31 - 1
REPORT_INTERVAL = "10 seconds"
STORE_INTERVAL_SECONDS = 300
OUTGOING_BATCH_SIZE = 100
UNKNOWN_CLIENT = "unknown"

# A batch is one request body, an array of at most 2^31 - 1 elements.
BATCH_STRIDE = 1 << 31
SEQ = T.DecimalType(38, 0)

WIRE_UPDATE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("delta", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("hash", T.StringType()),
    ]
)

STATE = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("metric_type", T.StringType()),
        T.StructField("gauge_value", T.DoubleType()),
        T.StructField("counter_value", T.LongType()),
        T.StructField("first_seen", T.TimestampNTZType()),
        # Arrival order of the gauge's update; NULL after a restore, older than any.
        T.StructField("gauge_seq", SEQ),
    ]
)
STATE_KEY = ["name", "metric_type"]

SNAPSHOT = T.StructType(
    [
        T.StructField("counters", T.MapType(T.StringType(), T.LongType())),
        T.StructField("gauges", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

AUDIT_EVENT = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("metrics", T.ArrayType(T.StringType())),
        T.StructField("ip_address", T.StringType()),
    ]
)
