"""Dead-letter retry planning: backoff, retry-or-give-up, republish records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.functions.alert_text import permanent_failure_text
from orderstream.functions.codec import (
    decode_order_json, decoded_columns, encode_order_json, header_int, kafka_key, with_headers,
)
from orderstream.functions.scalar import after_ms, backoff_ms
from orderstream.schema import BASE_BACKOFF_MS, MAX_RETRIES, ORDER_TOPIC, RETRY_HEADER

RETRY = "RETRY"
PERMANENT = "PERMANENT"


def decode_dlq_records(records: DataFrame) -> DataFrame:
    """Topic records -> decoded events + ``retry_count`` + record coordinates.

    Adds ``undecodable`` (true when the value is not a valid event JSON); those
    rows are skipped by the planner and land in the reject output.
    """
    cols = [c for c in ("topic", "partition", "offset", "key", "headers") if c in records.columns]
    rec_ts = F.col("timestamp").cast("timestamp") if "timestamp" in records.columns else F.lit(None).cast("timestamp")
    base = records.select(
        *cols, rec_ts.alias("record_ts"), F.col("value"),
        header_int("headers").alias("retry_count") if "headers" in records.columns
        else F.lit(0).cast("bigint").alias("retry_count"),
        decode_order_json("value").alias("_e"),
    )
    flat = base.select(*cols, "record_ts", "value", "retry_count", *decoded_columns("_e"))
    return flat.withColumnRenamed("malformed", "undecodable")


def plan_retries(dlq: DataFrame, max_retries: int = MAX_RETRIES, base_ms: int = BASE_BACKOFF_MS,
                 clock: str = "record_ts") -> DataFrame:
    """Stateless retry decision per dead-letter event.

    ``decision`` is PERMANENT once ``retry_count >= max_retries``, else RETRY
    with ``backoff_ms = base * 2^retry_count`` (a negative count as 0), ``next_retry_count`` and
    ``next_attempt_at = clock + backoff``.  Nothing sleeps inside a task; a
    release step (batch filter or the streaming timer) honours
    ``next_attempt_at``.
    """
    n = F.col("retry_count")
    permanent = n >= F.lit(max_retries)
    b = F.when(~permanent, backoff_ms(n, base_ms))
    return dlq.select(
        "*",
        F.when(permanent, F.lit(PERMANENT)).otherwise(F.lit(RETRY)).alias("decision"),
        b.alias("backoff_ms"),
        F.when(~permanent, n + 1).alias("next_retry_count"),
        F.when(~permanent, after_ms(clock, b)).alias("next_attempt_at"),
    )


def retry_records(planned: DataFrame, topic: str = ORDER_TOPIC, keep: tuple[str, ...] = ()) -> DataFrame:
    """RETRY rows as records for the original topic: key=user id, JSON value,
    ``retry-count`` header carrying the incremented count, other headers kept."""
    r = planned.where(F.col("decision") == RETRY)
    had = F.col("headers") if "headers" in planned.columns else None
    return r.select(
        *keep, kafka_key("user_id").alias("key"),
        encode_order_json().alias("value"),
        with_headers(had, {RETRY_HEADER: F.col("next_retry_count")}).alias("headers"),
        F.lit(topic).alias("topic"),
        "next_attempt_at",
    )


def permanent_failures(planned: DataFrame) -> DataFrame:
    """PERMANENT rows with their alert text."""
    return planned.where(F.col("decision") == PERMANENT).withColumn("alert_text", permanent_failure_text())


def undecodable_records(decoded: DataFrame) -> DataFrame:
    """Records skipped because their value could not be decoded (offset still advances)."""
    return decoded.where(F.col("undecodable"))


def release_due(planned: DataFrame, now) -> DataFrame:
    """Batch release: RETRY rows whose ``next_attempt_at`` has passed ``now``."""
    now_c = F.lit(now).cast("timestamp") if not hasattr(now, "_jc") else now
    return planned.where((F.col("decision") == RETRY) & (F.col("next_attempt_at") <= now_c))
