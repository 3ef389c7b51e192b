"""Order-event inputs derived from the driver tables (see FIXTURES.md).

Every derivation is a narrow projection (no shuffle) over a full table scan,
so the work grows with the table; ``plans/oracle.py`` holds the SQL twin of
each one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.functions.codec import encode_order_json, event_time, kafka_key
from orderstream.operators.validate import is_poison
from orderstream.schema import DLQ_TOPIC, ORDER_TOPIC, RETRY_HEADER
from orderstream.session import table_path

# Fixed values of the derivation (shared with the oracle SQL).
EPOCH0_MS = 1704067200000          # 2024-01-01 00:00:00 UTC
DENSE_FACTOR = 1000                # event-time compression of the dense variant
COUNTER_RESET_MS = EPOCH0_MS + 20 * 60 * 1000
SCRAPE_MS = 15000
NEGATIVE_COUNT, HUGE_COUNT = -3, 4_000_000_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _events(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _ts_ms(dense: bool) -> Column:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    if dense:
        ms = F.lit(EPOCH0_MS) + F.expr(f"(unix_millis(cast(ts as timestamp)) - {EPOCH0_MS}) div {DENSE_FACTOR}")
    return ms


def order_events(spark: SparkSession, sf_dir: str, dense: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """``events`` -> order events with ~2 % poison rows in three equal shapes."""
    e = _events(spark, sf_dir)
    m150 = F.col("event_id") % 150
    out = e.select(
        "event_id",
        F.when(m150 == 100, F.lit("")).otherwise(F.concat(F.lit("ord-"), F.col("event_id").cast("string"))).alias("order_id"),
        F.when(m150 == 50, F.lit("")).otherwise(F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("user_id"),
        F.when(m150 == 0, F.lit(-1.0) - F.col("value")).otherwise(F.col("value")).alias("amount"),
        F.when(F.col("event_id") % 50 == 0, F.lit("PLACED"))
        .when(F.col("event_type").isin("purchase", "signup"), F.lit("PLACED"))
        .when(F.col("event_type").isin("view", "click"), F.lit("SHIPPED"))
        .otherwise(F.lit("CANCELLED")).alias("status"),
        _ts_ms(dense).alias("timestamp"),
        *[F.col(c) for c in extra],
    )
    return out.withColumn("event_time", event_time("timestamp"))


def json_events(spark: SparkSession, sf_dir: str, dense: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Order events as JSON record values; every 1000th event (id % 1000 = 999)
    is truncated and every id % 1000 = 500 is empty, i.e. undecodable.  ``extra``
    names columns of the events to keep beside the value."""
    oe = order_events(spark, sf_dir, dense)
    m = F.col("event_id") % 1000
    js = encode_order_json()
    return oe.select(
        F.col("event_id").alias("offset"),
        F.when(m == 999, F.substring(js, 1, 25)).when(m == 500, F.lit("")).otherwise(js).alias("value"),
        *[F.col(c) for c in extra],
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON events as records of the order topic's 12 partitions, with coordinates; every 7th carries headers."""
    j = json_events(spark, sf_dir)
    header = F.array(F.struct(F.lit(RETRY_HEADER).alias("key"), (F.col("offset") % 3).cast("string").cast("binary").alias("value")))
    return j.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit(ORDER_TOPIC).alias("topic"),
                    (F.col("offset") % 12).cast("int").alias("partition"), "offset", F.timestamp_millis(F.col("offset")).alias("timestamp"),
                    F.when(F.col("offset") % 7 == 0, header).alias("headers"))


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poison events as dead-letter topic records with ``retry-count`` headers
    (``event_id div 50 % 7``) in several header shapes; every id % 900 = 0 has
    an undecodable value.  The headers of ids % 1100 = 50 hold a negative count,
    those of ids % 1300 = 100 one far beyond any backoff."""
    oe = order_events(spark, sf_dir).where(is_poison())
    eid = F.col("event_id")
    count = (F.when(eid % 1100 == 50, F.lit(NEGATIVE_COUNT)).when(eid % 1300 == 100, F.lit(HUGE_COUNT))
             .otherwise(F.expr("event_id div 50 % 7")))
    n = count.cast("string").cast("binary")

    def h(k, v):
        return F.struct(F.lit(k).alias("key"), v.alias("value"))

    headers = (
        F.when(eid % 4 == 1, F.array(h(RETRY_HEADER, F.lit("abc").cast("binary")), h(RETRY_HEADER, n)))
        .when(eid % 4 == 2, F.lit(None))
        .when(eid % 4 == 3, F.array(h("trace", F.lit("x").cast("binary")), h(RETRY_HEADER, n)))
        .otherwise(F.array(h(RETRY_HEADER, n)))
    )
    return oe.select(
        kafka_key("user_id").alias("key"),
        F.when(eid % 900 == 0, F.lit("not json")).otherwise(encode_order_json()).cast("binary").alias("value"),
        F.lit(DLQ_TOPIC).alias("topic"),
        F.expr("event_id div 50 % 3").cast("int").alias("partition"),
        eid.alias("offset"),
        F.col("event_time").alias("timestamp"),
        headers.alias("headers"),
    )


def order_events_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events plus a second copy of every id % 97 = 0 (at-least-once redelivery)."""
    oe = order_events(spark, sf_dir)
    return oe.unionByName(oe.where(F.col("event_id") % 97 == 0))


def send_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A producer send log: one batch of 100 per event, duration = value,
    failed when the event type is 'error'."""
    e = _events(spark, sf_dir)
    ms = _ts_ms(True)
    return e.select(
        F.timestamp_millis(ms).alias("ts"),
        F.col("event_type").alias("request"),
        F.lit(100).alias("batch_size"),
        F.col("value").alias("duration_ms"),
        (F.col("event_type") == "error").alias("error"),
    )


def orders_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TPC-H ``orders`` as order events (day-granular event time)."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    out = o.select(
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("user-"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "O", "PLACED").when(F.col("o_orderstatus") == "F", "SHIPPED")
        .when(F.col("o_orderstatus") == "P", "CANCELLED").alias("status"),
        ms.alias("timestamp"),
    )
    return out.withColumn("event_time", event_time("timestamp"))


# Gauges for the alert rules: (metric, instance, out of so many scrape intervals the
# first so many have the odd value, odd value, normal value).
GAUGES = [
    ("kafka_server_replica_manager_under_replicated_partitions", "kafka-2", 40, 8, 2, 0),
    ("kafka_controller_offline_partitions_count", "kafka-1", 60, 3, 1, 0),
    ("kafka_controller_active_controller_count", "kafka-1", 50, 6, 0, 1),
    ("flink_jobmanager_job_lastCheckpointDuration", "flink-1", 45, 25, 70000, 5000),
    ("flink_jobmanager_job_uptime", "flink-1", 80, 12, 0, 60000),
]
FAILED_CHECKPOINTS = "flink_jobmanager_job_numberOfFailedCheckpoints"
MESSAGES_IN = "kafka_server_broker_topic_metrics_messages_in_total"
PRODUCE_P99 = "kafka_network_request_metrics_produce_total_time_ms_p99"


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples scraped every 15 s, derived from the dense order events.

    * ``messages_in_total`` - a counter per (topic, instance): valid events count
      on ``order-events``, poison events on ``order-events-dlq``; instance
      ``kafka-(1 + event_id % 3)``.  ``kafka-2`` restarts (counter reset to 0)
      at ``COUNTER_RESET_MS``.  Samples exist where the series had traffic.
    * ``produce_total_time_ms_p99`` - a gauge per instance: max event value in
      the scrape interval / 20.
    * for the other alert rules: gauges per instance that leave their normal value
      for some scrape intervals in every so many (``GAUGES``), and a counter of
      failed checkpoints that grows every 30 intervals.

    The running count is taken over per-interval pre-aggregates, so each
    series window holds one row per scrape interval, not one per event.
    """
    from orderstream.schema import DLQ_TOPIC as _DLQ, ORDER_TOPIC as _ORD
    from pyspark.sql import Window

    oe = order_events(spark, sf_dir, dense=True, extra=("value",))
    base = oe.select(
        F.when(is_poison(), F.lit(_DLQ)).otherwise(F.lit(_ORD)).alias("topic"),
        F.concat(F.lit("kafka-"), (F.col("event_id") % 3 + 1).cast("string")).alias("instance"),
        (F.col("timestamp") - F.col("timestamp") % SCRAPE_MS).alias("bucket_ms"),
        F.col("value"),
    )
    # per (topic, instance, interval) count and max value; the gauges are folded
    # from these pre-aggregates (a few rows per interval)
    counts = base.groupBy("topic", "instance", "bucket_ms").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("mx"))
    seg = ((F.col("instance") == "kafka-2") & (F.col("bucket_ms") >= COUNTER_RESET_MS)).alias("segment")
    w = (Window.partitionBy("topic", "instance", "segment").orderBy("bucket_ms")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counter = counts.select("*", seg).select(
        F.lit(MESSAGES_IN).alias("metric"), "topic", "instance",
        F.timestamp_millis("bucket_ms").alias("ts"),
        F.sum("n").over(w).cast("double").alias("value"),
    )
    gauge = counts.groupBy("instance", "bucket_ms").agg(F.max("mx").alias("mx")).select(
        F.lit(PRODUCE_P99).alias("metric"), F.lit(None).cast("string").alias("topic"), "instance",
        F.timestamp_millis("bucket_ms").alias("ts"), (F.col("mx") / 20.0).alias("value"),
    )
    k = F.expr(f"(bucket_ms - {EPOCH0_MS}) div {SCRAPE_MS}")
    others = [F.struct(F.lit(metric).alias("metric"), F.lit(instance).alias("instance"),
                       F.when(k % every < first, F.lit(float(odd))).otherwise(F.lit(float(normal))).alias("value"))
              for metric, instance, every, first, odd, normal in GAUGES]
    others.append(F.struct(F.lit(FAILED_CHECKPOINTS).alias("metric"), F.lit("flink-1").alias("instance"),
                           F.expr(f"(bucket_ms - {EPOCH0_MS}) div {30 * SCRAPE_MS}").cast("double").alias("value")))
    rest = (counts.select("bucket_ms").distinct().select("bucket_ms", F.explode(F.array(*others)).alias("g"))
            .select("g.metric", F.lit(None).cast("string").alias("topic"), "g.instance", F.timestamp_millis("bucket_ms").alias("ts"), "g.value"))
    return counter.unionByName(gauge).unionByName(rest)


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples as an exporter prints them: value as text (every tenth isn't a number), time in seconds."""
    e = _events(spark, sf_dir)
    return e.select("event_id", F.when(F.col("event_id") % 10 == 3, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("v"),
                    (_ts_ms(False) / F.lit(1000.0)).alias("t"))


JMX_BEANS = [
    # Sample MBean names in the exporter's "domain<key=value, ...><>attribute" form.
    ("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic={t}><>OneMinuteRate", True),
    ("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec, topic={t}><>OneMinuteRate", True),
    ("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec><>OneMinuteRate", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>99thPercentile", False),
    ("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=FetchConsumer><>Mean", False),
    ("kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value", False),
    ("kafka.controller<type=KafkaController, name=ActiveControllerCount><>Value", False),
    ("kafka.log<type=LogFlushStats, name=LogFlushRateAndTimeMs><>Count", False),
]
JMX_TOPICS = ["order-events", "order-events-dlq", "order-stats"]


def jmx_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw MBean samples (name, value) derived from ``events``: bean shape by
    ``event_id % 8``, topic by ``user_id % 3``; some with text before the bean, some
    with the value after it, as scrapers print them."""
    e = _events(spark, sf_dir)
    topic = F.element_at(F.array(*[F.lit(t) for t in JMX_TOPICS]), (F.col("user_id") % 3 + 1).cast("int"))
    k = F.col("event_id") % len(JMX_BEANS)
    name = None
    for i, (tmpl, has_topic) in enumerate(JMX_BEANS):
        if has_topic:
            pre, post = tmpl.split("{t}")
            txt = F.concat(F.lit(pre), topic, F.lit(post))
        else:
            txt = F.lit(tmpl)
        name = F.when(k == i, txt) if name is None else name.when(k == i, txt)
    before = F.when(F.col("event_id") % 5 == 1, F.lit("jmx ")).otherwise(F.lit(""))
    after = F.when(F.col("event_id") % 7 == 2, F.lit(": 1.5")).otherwise(F.lit(""))
    return e.select("event_id", F.concat(before, name, after).alias("mbean"), F.col("value"))
