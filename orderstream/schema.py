"""Record schemas and job defaults."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"

# One order event as it travels on the wire (JSON value of a topic record).
ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

ORDER_EVENT_WITH_CORRUPT = T.StructType(
    ORDER_EVENT.fields + [T.StructField(CORRUPT_COL, T.StringType())]
)

HEADER = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
])

# Shape of a record read from / written to a topic (also used by the
# file-backed stand-in source in tests).
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", T.ArrayType(HEADER)),
])

USER_ORDER_STATS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("order_count", T.LongType(), False),
    T.StructField("total_amount", T.DoubleType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("window_end", T.TimestampType(), False),
])

METRIC_SAMPLE = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("instance", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])

SEND_LOG = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("batch_size", T.IntegerType()),
    T.StructField("duration_ms", T.DoubleType()),
    T.StructField("error", T.BooleanType()),
])

# Fixed values that must agree with the reference job's configuration.
ORDER_TOPIC = "order-events"
DLQ_TOPIC = "order-events-dlq"
STATS_TOPIC = "order-stats"
RETRY_HEADER = "retry-count"
REASON_HEADER = "dlq-reason"
PLACED = "PLACED"
WINDOW = "1 minute"
WATERMARK_DELAY = "5 seconds"
MAX_RETRIES = 5
BASE_BACKOFF_MS = 1000
STATS_KEYS = ("user_id", "window_start")
STATS_UPDATE_COLS = ("order_count", "total_amount")

# DLQ reasons, in the order they are tested.
MALFORMED_JSON = "MALFORMED_JSON"
NEGATIVE_AMOUNT = "NEGATIVE_AMOUNT"
MISSING_USER_ID = "MISSING_USER_ID"
MISSING_ORDER_ID = "MISSING_ORDER_ID"
