"""Topic source/sink builders.

The Kafka connector jar is not on this image's classpath, so these are built
and option-checked in tests but not executed here; on a cluster with the
``spark-sql-kafka`` package they run as written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.functions.codec import encode_order_json, header_int, kafka_key, with_headers
from orderstream.schema import DLQ_TOPIC, MALFORMED_JSON, ORDER_TOPIC, REASON_HEADER, RETRY_HEADER, STATS_TOPIC


def source_options(brokers: str, topic: str, starting: str = "latest", group_id: str | None = None,
                   min_partitions: int | None = None, fail_on_data_loss: bool = True) -> dict:
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
        "includeHeaders": "true",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_order_events(spark: SparkSession, brokers: str, topic: str = ORDER_TOPIC, starting: str = "latest",
                      **kw) -> DataFrame:
    """Order-event topic as a stream (value-only JSON; headers kept)."""
    return spark.readStream.format("kafka").options(**source_options(brokers, topic, starting, **kw)).load()


def read_dlq(spark: SparkSession, brokers: str, topic: str = DLQ_TOPIC, **kw) -> DataFrame:
    """Dead-letter topic from the oldest offset."""
    return read_order_events(spark, brokers, topic, starting="earliest", **kw)


def sink_options(brokers: str, topic: str, idempotent: bool = True) -> dict:
    opts = {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.acks": "all"}
    if idempotent:
        opts["kafka.enable.idempotence"] = "true"
    return opts


def as_dlq_records(dlq: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Dead-letter events -> records.

    The value is the event's JSON, but a malformed record keeps its own bytes
    (column ``value``) and key; nothing could be re-encoded from it.  Headers
    travel on: ``retry-count`` keeps the count it came with (0 if none) and
    ``dlq-reason`` is added.
    """
    has = set(dlq.columns)
    malformed = F.col("dlq_reason") == F.lit(MALFORMED_JSON)
    key, value = kafka_key("user_id"), encode_order_json().cast("binary")
    if "key" in has:
        key = F.when(malformed, F.col("key").cast("binary")).otherwise(key)
    if "value" in has:
        value = F.when(malformed, F.col("value").cast("binary")).otherwise(value)
    headers = F.col("headers") if "headers" in has else None
    count = header_int("headers") if headers is not None else F.lit(0)
    return dlq.select(*keep, key.alias("key"), value.alias("value"),
                      with_headers(headers, {RETRY_HEADER: count, REASON_HEADER: F.col("dlq_reason")}).alias("headers"))


def as_stats_records(stats: DataFrame) -> DataFrame:
    """Window results -> records keyed by user (downstream dedupes on user+window)."""
    return stats.select(
        kafka_key("user_id").alias("key"),
        F.to_json(F.struct("user_id", "order_count", "total_amount", "window_start", "window_end")).alias("value"),
    )


def write_stream(records: DataFrame, brokers: str, topic: str, checkpoint: str, trigger: dict | None = None):
    """Records (key, value[, headers]) to a topic; at-least-once."""
    w = (records.writeStream.format("kafka").options(**sink_options(brokers, topic))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_dlq(dlq: DataFrame, brokers: str, checkpoint: str, topic: str = DLQ_TOPIC):
    return write_stream(as_dlq_records(dlq), brokers, topic, checkpoint)


def write_retries(retry_records: DataFrame, brokers: str, checkpoint: str, topic: str = ORDER_TOPIC):
    """Republish RETRY records (``retry-count`` header already incremented)."""
    return write_stream(retry_records.select("key", "value", "headers"), brokers, topic, checkpoint)


def write_stats(stats: DataFrame, brokers: str, checkpoint: str, topic: str = STATS_TOPIC):
    return write_stream(as_stats_records(stats), brokers, topic, checkpoint)


def partition_by_key(df: DataFrame, n: int, key: str = "user_id", order: str = "timestamp") -> DataFrame:
    """Keyed, ordered layout for tables (the table analogue of keyed publish).

    Range-partitioned on (key, order): every partition holds a contiguous
    slice of keys in event order, so a key's rows are read back in order
    across consecutive partitions.  Unlike a hash on the key alone, a key that
    holds a large share of all rows is split over several partitions instead
    of landing in one task.
    """
    return df.repartitionByRange(n, key, order).sortWithinPartitions(key, order)
