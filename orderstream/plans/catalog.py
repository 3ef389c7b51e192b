"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver tables (through ``plans.fixtures``) in full and returns
a result whose column names match the SQL twin in ``plans.oracle``.
Timestamps leave as zone-less values (``timestamp_ntz``).
"""

from __future__ import annotations

import functools
import itertools

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderstream.functions.alert_text import alert_payload, dlq_alert_text
from orderstream.functions.codec import encode_order_json, header_int
from orderstream.functions.metric_names import parse_metric_names
from orderstream.functions.scalar import band, from_epoch_s, naive, sample_value
from orderstream.operators import alerts as AL
from orderstream.operators import analytics as AN
from orderstream.operators import loadtest as LT
from orderstream.operators import metrics as M
from orderstream.operators import retry as R
from orderstream.operators import sketches as SK
from orderstream.operators.maintained import MaintainedTotals
from orderstream.operators.upsert import dedup_first, dedup_streaming, upsert_latest
from orderstream.operators.validate import decode_events, status_is, tag_events
from orderstream.operators.windows import guarded_filter, windowed_stats, with_event_watermark
from orderstream.plans import fixtures as FX
from orderstream.schema import MAX_RETRIES, ORDER_EVENT, REASON_HEADER, TOPIC_RECORD, USER_ORDER_STATS
from orderstream.session import apply_core_conf, scratch_path, table_path
from orderstream.sources.files import dlq_archive, read_samples, read_value_stream, write_summary, write_values
from orderstream.sources.kafka import as_dlq_records, partition_by_key
from orderstream.sources.notify import AlertSink
from orderstream.sources.once import OnceTable
from orderstream.sources.tables import KeyedTable
from orderstream.streaming.job import dlq_plan, order_stats_plan, start_split_job, tagged_events

# Fixed query parameters.
TOP_N = 20
LATEST_WINDOWS = 60
RANGE_START = "2024-01-01 00:20:00"
RANGE_END = "2024-01-01 00:35:00"
INSTANT_AT = "2024-01-01 00:30:00"
ALERT_SINCE, ALERT_AT = "2024-01-01 00:10:00", "2024-01-01 00:40:00"


def _stats_out(df: DataFrame) -> DataFrame:
    return df.select("user_id", "order_count", "total_amount",
                     naive("window_start").alias("window_start"), naive("window_end").alias("window_end"))


def _placed_valid(oe: DataFrame) -> DataFrame:
    t = tag_events(oe, None)
    return t.where(F.col("dlq_reason").isNull() & status_is("PLACED"))


def order_stats(spark: SparkSession, sf_dir: str, width: str = "1 minute") -> DataFrame:
    """Per-user one-minute stats of valid PLACED orders (two-decimal amounts)."""
    return windowed_stats(_placed_valid(FX.order_events(spark, sf_dir, dense=True)), width=width, exact=True)


_STORED: dict[tuple[str, str], tuple[list, KeyedTable]] = {}


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time of change) of the files under a path of any store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def stored_stats(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """The result table as the dashboards read it: written once a session and state of the input's files."""
    key = (spark.sparkContext.applicationId, sf_dir)
    files = _files(spark, table_path(sf_dir, "events"))
    if key not in _STORED or _STORED[key][0] != files:
        table = KeyedTable(scratch_path(spark, "user-order-stats"))
        table.write_batch(order_stats(spark, sf_dir), 0)
        _STORED[key] = files, table
    return _STORED[key][1]


# ---- validation and routing ------------------------------------------------

def q_validate_events(spark, sf_dir):
    oe = FX.order_events(spark, sf_dir)
    t = tag_events(oe, None)
    return t.select("event_id", "order_id", "user_id", "amount", "status", "timestamp",
                    naive("event_time").alias("event_time"), "dlq_reason")


def q_decode_validate(spark, sf_dir):
    js = FX.json_events(spark, sf_dir)
    d = tag_events(decode_events(js, keep=("offset",)))
    return d.select(F.col("offset").alias("event_id"), "order_id", "user_id", "amount", "status", "timestamp",
                    naive("event_time").alias("event_time"), "dlq_reason")


def q_valid_events(spark, sf_dir):
    t = tag_events(FX.order_events(spark, sf_dir), None)
    return t.where(F.col("dlq_reason").isNull()).select("event_id", "order_id", "user_id", "amount", "status", "timestamp")


def q_dlq_events(spark, sf_dir):
    t = tag_events(FX.order_events(spark, sf_dir), None)
    return t.where(F.col("dlq_reason").isNotNull()).select("event_id", "order_id", "user_id", "amount", "status",
                                                           "timestamp", "dlq_reason")


def q_dlq_payload(spark, sf_dir):
    t = tag_events(FX.order_events(spark, sf_dir), None)
    d = t.where(F.col("dlq_reason").isNotNull())
    return d.select("event_id", F.col("user_id").cast("binary").cast("string").alias("record_key"),
                    encode_order_json().alias("record_value"))


def q_dlq_rate(spark, sf_dir):
    return AN.dlq_accounting(tag_events(decode_events(FX.json_events(spark, sf_dir))))


def q_dlq_rate_by_window(spark, sf_dir):
    t = tag_events(FX.order_events(spark, sf_dir, dense=True), None)
    g = AN.dlq_accounting(t, by=[F.window("event_time", "5 minutes").alias("w")])
    return g.select(naive("w.start").alias("window_start"), *[c for c in g.columns if c != "w"])


def q_partitioned_by_user(spark, sf_dir):
    t = tag_events(FX.order_events(spark, sf_dir), None).where(F.col("dlq_reason").isNull())
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return partition_by_key(t.select("user_id", "order_id", "amount", "status", "timestamp"), n)


# ---- windowed stats and dashboard ------------------------------------------

def q_order_stats_1m(spark, sf_dir):
    return _stats_out(order_stats(spark, sf_dir))


def q_orders_daily_stats(spark, sf_dir):
    oe = FX.orders_as_events(spark, sf_dir)
    return _stats_out(windowed_stats(_placed_valid(oe), width="1 day", exact=True))


def q_top_users(spark, sf_dir):
    return AN.top_users(stored_stats(spark, sf_dir).read(spark), TOP_N, exact=True)


def q_revenue_over_time(spark, sf_dir):
    r = AN.revenue_over_time(stored_stats(spark, sf_dir).latest(spark, LATEST_WINDOWS), LATEST_WINDOWS, exact=True)
    return r.select(naive("window_start").alias("window_start"), "total_amount")


def q_volume_over_time(spark, sf_dir):
    r = AN.volume_over_time(stored_stats(spark, sf_dir).latest(spark, LATEST_WINDOWS), LATEST_WINDOWS)
    return r.select(naive("window_start").alias("window_start"), "order_count")


def q_kpi_top20(spark, sf_dir):
    return AN.kpis(AN.top_users(stored_stats(spark, sf_dir).read(spark), TOP_N, exact=True), exact=True)


def q_kpi_global(spark, sf_dir):
    return AN.kpis(stored_stats(spark, sf_dir).read(spark), exact=True)


def q_upsert_latest(spark, sf_dir):
    oe = _placed_valid(FX.order_events(spark, sf_dir, dense=True))
    b0 = windowed_stats(oe.where(F.col("event_id") % 2 == 0), exact=True).withColumn("batch_id", F.lit(0).cast("bigint"))
    b1 = windowed_stats(oe, exact=True).withColumn("batch_id", F.lit(1).cast("bigint"))
    return _stats_out(upsert_latest(b0.unionByName(b1)))


def q_dedup_orders(spark, sf_dir):
    t = tag_events(FX.order_events_dup(spark, sf_dir), None).where(F.col("dlq_reason").isNull())
    d = dedup_first(t.select("event_id", "order_id", "user_id", "amount", "status", "timestamp"))
    return d


# ---- dead-letter retries -----------------------------------------------------

def _planned(spark, sf_dir):
    return R.plan_retries(R.decode_dlq_records(FX.dlq_records(spark, sf_dir)).where(~F.col("undecodable")))


def q_retry_plan(spark, sf_dir):
    p = _planned(spark, sf_dir)
    return p.select("offset", "partition", "order_id", "user_id", "amount", "status", "retry_count", "decision",
                    "backoff_ms", "next_retry_count", naive("next_attempt_at").alias("next_attempt_at"))


def q_retry_outcomes(spark, sf_dir):
    d = R.decode_dlq_records(FX.dlq_records(spark, sf_dir))
    p = R.plan_retries(d)
    dec = F.when(F.col("undecodable"), F.lit("REJECTED")).otherwise(F.col("decision"))
    return p.groupBy(dec.alias("decision")).agg(F.count(F.lit(1)).alias("records"))


def q_retry_permanent_alerts(spark, sf_dir):
    p = R.permanent_failures(_planned(spark, sf_dir))
    return p.select("offset", "alert_text")


def q_dlq_alert_text(spark, sf_dir):
    r = FX.dlq_records(spark, sf_dir)
    return r.select("offset", dlq_alert_text("value", "topic", "partition").alias("alert_text"))


def q_dlq_roundtrip(spark, sf_dir):
    """Every dead-letter record through the whole loop: order topic -> dead-letter
    topic -> retry plan -> order topic, until it is PERMANENT. The events stay
    bad, so a record comes back once for every retry; a malformed value is
    rejected by the first plan with its own bytes. Each topic is a written table."""
    topic = FX.json_events(spark, sf_dir).select(
        F.col("offset"), F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"))
    ended = []
    for _ in range(MAX_RETRIES + 1):
        bad = dlq_plan(topic, keep=("offset",))
        path = scratch_path(spark, "dlq-topic")
        as_dlq_records(bad, keep=("offset",)).write.parquet(path)
        dlq = R.plan_retries(R.decode_dlq_records(spark.read.parquet(path)).withColumn("record_ts", F.timestamp_millis(F.lit(0))))
        reason = F.decode(F.filter("headers", lambda h: h["key"] == REASON_HEADER)[0]["value"], "UTF-8")
        over = F.when(F.col("undecodable"), F.lit("REJECTED")).when(F.col("decision") == R.PERMANENT, F.lit(R.PERMANENT))
        ended.append(dlq.select(F.col("offset").alias("event_id"), reason.alias("reason"), F.col("retry_count").alias("attempts"),
                                over.alias("outcome"), F.hex("value").alias("value_hex")).where(F.col("outcome").isNotNull()))
        again = dlq.where(~F.col("undecodable"))
        topic = R.retry_records(again, keep=("offset",)).select("offset", "key", F.col("value").cast("binary").alias("value"), "headers")
    return functools.reduce(DataFrame.unionByName, ended)


# ---- metrics and alerts --------------------------------------------------------

def _samples_out(df: DataFrame, value: str = "value") -> DataFrame:
    return df.select("metric", "topic", "instance", naive("ts").alias("ts"), F.col(value).alias("value"))


def q_metric_latest(spark, sf_dir):
    return _samples_out(M.instant(FX.metric_samples(spark, sf_dir), INSTANT_AT))


def q_metric_range(spark, sf_dir):
    return _samples_out(M.range_query(FX.metric_samples(spark, sf_dir), RANGE_START, RANGE_END))


def q_metric_sum(spark, sf_dir):
    s = M.select_series(FX.metric_samples(spark, sf_dir), FX.MESSAGES_IN, topic="order-events")
    r = M.sum_by(M.range_query(s, RANGE_START, RANGE_END))
    return r.select("metric", naive("ts").alias("ts"), "value")


def q_per_instance_latest(spark, sf_dir):
    """Newest message counter of every instance at a time. kafka-3 has been silent for six minutes by then and has gone;
    'unknown' has two series, one without an instance label and one with an empty one a scrape older."""
    s = FX.metric_samples(spark, sf_dir)
    silent = (F.col("instance") == "kafka-3") & (F.col("ts") > F.lit(INSTANT_AT).cast("timestamp") - F.expr("INTERVAL 6 MINUTES"))
    other = s.where(F.col("instance") == "kafka-2")
    bare = other.withColumn("instance", F.lit(None).cast("string")).withColumn("value", F.col("value") + 1000)
    empty = other.withColumn("instance", F.lit("")).withColumn("value", F.col("value") + 2000).withColumn("ts", F.col("ts") - F.expr("INTERVAL 15 SECONDS"))
    r = M.latest_by_instance(s.where(~F.coalesce(silent, F.lit(False))).unionByName(bare).unionByName(empty), FX.MESSAGES_IN, at=INSTANT_AT, topic="order-events")
    return r.select("instance", naive("ts").alias("ts"), "value")


def q_metric_rate_5m(spark, sf_dir):
    s = M.select_series(FX.metric_samples(spark, sf_dir), FX.MESSAGES_IN)
    return _samples_out(M.rate(s, 300, start=RANGE_START, end=RANGE_END), "rate")


def q_metric_increase_5m(spark, sf_dir):
    s = M.select_series(FX.metric_samples(spark, sf_dir), FX.MESSAGES_IN)
    return _samples_out(M.increase(s, 300, start=RANGE_START, end=RANGE_END), "increase")


def q_dlq_rate_sum_range(spark, sf_dir):
    """``sum(rate(messages_in{topic=dlq}[5m]))`` on the dashboard's step grid."""
    s = M.select_series(FX.metric_samples(spark, sf_dir), FX.MESSAGES_IN, topic="order-events-dlq")
    return M.sum_rate_range(s, RANGE_START, RANGE_END).select("metric", naive("ts").alias("ts"), "value")


def _states(spark, sf_dir):
    return AL.alert_states(FX.metric_samples(spark, sf_dir), since=ALERT_SINCE, at=ALERT_AT)


def _alert_out(df: DataFrame) -> DataFrame:
    return df.select("alert", "metric", "topic", "instance", naive("ts").alias("ts"), "value", "state",
                     naive("active_at").alias("active_at"), "severity", "summary")


def q_alert_states(spark, sf_dir):
    return _alert_out(_states(spark, sf_dir))


def q_alert_timeline(spark, sf_dir):
    return _alert_out(AL.alert_timeline(FX.metric_samples(spark, sf_dir), since=ALERT_SINCE, at=ALERT_AT))


def q_active_alerts(spark, sf_dir):
    """Alerts currently firing or pending for the DLQ and latency rules."""
    st = AL.by_name(AL.by_state(_states(spark, sf_dir), "firing", "pending"), "DLQEventsDetected", "DLQHighRate",
                    "KafkaHighProducerLatency")
    return _alert_out(st)


def q_alert_state_counts(spark, sf_dir):
    return AL.state_counts(_states(spark, sf_dir))


def q_status_bands(spark, sf_dir):
    """Produce latency by instance, and the summed dead-letter rate on the step grid."""
    samples = FX.metric_samples(spark, sf_dir)
    s = M.select_series(samples, FX.PRODUCE_P99)
    r = M.sum_rate_range(M.select_series(samples, FX.MESSAGES_IN, topic="order-events-dlq"), RANGE_START, RANGE_END)
    lat = s.select("metric", "instance", naive("ts").alias("ts"), "value",
                   band("value", 10, 6).alias("band"))
    dlq = r.select("metric", F.lit(None).cast("string").alias("instance"), naive("ts").alias("ts"), "value",
                   band("value", 5, 1).alias("band"))
    return lat.unionByName(dlq)


def q_metric_names_parsed(spark, sf_dir):
    p = parse_metric_names(FX.jmx_samples(spark, sf_dir))
    return p.select("event_id", "metric", "topic", "value")


# ---- streaming ---------------------------------------------------------------------

SENTINEL_USER = "__end_of_stream__"
LATE_USER = "__late__"
STREAM_PARTS = 4


def q_stream_order_stats(spark, sf_dir):
    """The streaming job end to end: dense order events as JSON files -> file
    stream -> decode/validate/guarded filter/watermark/window -> keyed table
    (idempotent per-batch upsert).

    The events arrive in ``STREAM_PARTS`` data batches by event time; before the
    last one a valid order for the first window arrives and is dropped as late.
    Two far-future sentinel events then close every data window; the sentinel
    user is excluded from the result."""
    apply_core_conf(spark)
    src, out, ck = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ck"))
    events = FX.json_events(spark, sf_dir, dense=True, extra=("timestamp",))
    low, high = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    table = KeyedTable(out)

    def arrive(df):
        write_values(df, src)

    def order(order_id, user_id, ms):
        return spark.range(1).select(encode_order_json(
            order_id=F.lit(order_id), user_id=F.lit(user_id), amount=F.lit(0.0), status=F.lit("PLACED"), timestamp=F.lit(ms)).alias("value"))

    if low is None:
        return _stats_out(spark.createDataFrame([], USER_ORDER_STATS))
    part = F.least(F.expr(f"(`timestamp` - {low}) * {STREAM_PARTS} div {high - low + 1}"), F.lit(STREAM_PARTS - 1))
    arrive(events.where(part == 0))
    plan = order_stats_plan(read_value_stream(spark, src), exact=True)
    q = (plan.writeStream.outputMode("append").foreachBatch(table.write_batch)
         .option("checkpointLocation", ck).start())
    try:
        q.processAllAvailable()
        for i in range(1, STREAM_PARTS):
            if i == STREAM_PARTS - 1:
                arrive(order("late", LATE_USER, low))
                q.processAllAvailable()
            arrive(events.where(part == i))
            q.processAllAvailable()
        for i in range(2):
            arrive(order(f"end-{i}", SENTINEL_USER, 4102444800000 + i))
            q.processAllAvailable()
    finally:
        q.stop()
    return _stats_out(table.read(spark).where(F.col("user_id") != SENTINEL_USER))


def q_stream_retry_release(spark, sf_dir):
    """Dead-letter records through the retry release (default 1 s base backoff):
    every decodable record comes out once - PERMANENT at once, RETRY when its
    backoff is over, with the incremented count."""
    from orderstream.streaming.retry_release import run_release

    recs = FX.dlq_records(spark, sf_dir)
    src, ck, out = (scratch_path(spark, n) for n in ("retry-src", "retry-ck", "retry-out"))
    recs.write.parquet(src)
    rel = run_release(spark, src, recs.schema, ck, out)
    return rel.select("offset", "order_id", "user_id", "retry_count", "decision")


class _Broken(RuntimeError):
    """The forced end of a job in a query that shows how it goes on."""


def _until_broken(query) -> None:
    """Waits for a query that is to end with ``_Broken``; any other failure is raised."""
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if "_Broken" not in str(e):
            raise


#: Rows of one file of a lot, about, if a lot is large.
FILE_ROWS = 250_000


def _files_of_a_lot(rows: DataFrame, lots: int) -> int:
    """So many files for each of ``lots`` lots: one file for a small lot, and files of a bounded size for a large one."""
    return max(1, rows.count() // (lots * FILE_ROWS))


def _append_lot(lot: DataFrame, path: str, files: int) -> None:
    """The table is read by many tasks and the lot dealt to its files' tasks; none reads the table alone."""
    lot.repartition(files).write.mode("append").parquet(path)


def _parts_by_offset(records: DataFrame, path: str, parts: int = STREAM_PARTS) -> int:
    """The records as ``parts`` lots of Parquet files under ``path``, dealt by offset. Returns the files of a lot, for a trigger to take."""
    files = _files_of_a_lot(records, parts)
    for i in range(parts):
        _append_lot(records.where(F.expr(f"offset div 50 % {parts}") == i), path, files)
    return files


def q_stream_retry_continuous(spark, sf_dir):
    """Dead letters through the running retry service on a hand-driven clock: they arrive in four files, while a second
    thread of work releases what has fallen due and publishes it to the order topic's table; then the clock
    jumps from one due time to the next. Every republished record and every permanent failure, each once."""
    from orderstream.streaming.retry_release import RETRY_RECORD, RetryRelease

    apply_core_conf(spark)
    recs = FX.dlq_records(spark, sf_dir)
    src, ck, out, topic = (scratch_path(spark, n) for n in ("retry-src", "retry-ck", "retry-out", "retry-topic"))
    ticks = itertools.count(1_700_000_000_000, 400)
    clock = {"least": 0}
    table = RetryRelease(spark, out, clock_ms=lambda: max(next(ticks), clock["least"]))
    republished = OnceTable(topic, RETRY_RECORD, run="retries")
    files = _files_of_a_lot(recs, STREAM_PARTS)
    recs.limit(0).write.parquet(src)
    ingest = (spark.readStream.schema(recs.schema).option("maxFilesPerTrigger", str(files)).parquet(src).writeStream.foreachBatch(table.ingest)
              .option("checkpointLocation", ck).start())
    try:
        for i in range(STREAM_PARTS):
            _append_lot(recs.where(F.expr(f"offset div 50 % {STREAM_PARTS}") == i), src, files)
            table.release()  # while the part is being taken in
            table.publish(republished.write_batch)
        ingest.processAllAvailable()
        while (due := table.release()) is not None:
            table.publish(republished.write_batch)
            clock["least"] = due
        table.publish(republished.write_batch)
    finally:
        ingest.stop()
    text = lambda c: F.col(c).cast("binary").cast("string")
    permanent = table.released().where(F.col("decision") == R.PERMANENT)
    sent = republished.read(spark).select("partition", "offset", F.lit(R.RETRY).alias("decision"), text("key").alias("record_key"),
                                          text("value").alias("record_value"), header_int("headers").alias("retry_header"))
    return sent.unionByName(permanent.select("partition", "offset", "decision", text("key").alias("record_key"), F.col("value").alias("record_value"),
                                             header_int("headers").alias("retry_header")))


def q_stream_dlq_once(spark, sf_dir):
    """Dead letters of the order topic appended to a table once: the job ends between a batch's rows and its commit, goes on from
    its checkpoint, and then runs again from the first offset with a new checkpoint."""
    apply_core_conf(spark)
    src, out = (scratch_path(spark, n) for n in ("once-src", "once-out"))
    records = FX.order_records(spark, sf_dir)
    files = _parts_by_offset(records, src)
    schema = T.StructType([f for f in TOPIC_RECORD.fields if f.name != "timestamp"])
    broken = []

    class Breaks(OnceTable):
        def write_rows(self, df, path):
            super().write_rows(df, path)
            if path.endswith("batch_id=1") and not broken:
                broken.append(path)
                raise _Broken("after the rows, before the commit")

    table = Breaks(out, schema, offset_range=1000)

    def run(ck):
        stream = spark.readStream.schema(TOPIC_RECORD).option("maxFilesPerTrigger", str(files)).parquet(src)
        at = ("topic", "partition", "offset")
        dead = as_dlq_records(dlq_plan(stream, keep=at), keep=at)
        return dead.writeStream.foreachBatch(table.write_batch).option("checkpointLocation", ck).trigger(availableNow=True).start()

    first, second = scratch_path(spark, "once-ck"), scratch_path(spark, "once-ck")
    _until_broken(run(first))
    run(first).awaitTermination()
    run(second).awaitTermination()
    reason = F.filter("headers", lambda h: h["key"] == REASON_HEADER)[0]["value"].cast("string")
    return table.read(spark).select("topic", "partition", "offset", F.hex("value").alias("value_hex"), header_int("headers").alias("retry_header"),
                                    reason.alias("reason"))


def q_stream_split_job(spark, sf_dir):
    """Valid events and dead letters from one query and one checkpoint; the job ends between a batch's two writes and
    is started again."""
    apply_core_conf(spark)
    src, dead, good, ck = (scratch_path(spark, n) for n in ("split-src", "split-dead", "split-good", "split-ck"))
    files = _parts_by_offset(FX.order_records(spark, sf_dir), src)
    at = [f for f in TOPIC_RECORD.fields if f.name in ("topic", "partition", "offset")]
    event = [f for f in ORDER_EVENT.fields]
    dlq = OnceTable(dead, T.StructType([*at, *event, T.StructField("dlq_reason", T.StringType())]))
    valid = OnceTable(good, T.StructType([*at, *event]))
    broken = []

    def valid_sink(df, batch_id):
        if batch_id == 2 and not broken:
            broken.append(batch_id)
            raise _Broken("between the two outputs")
        valid.write_batch(df, batch_id)

    def start():
        stream = spark.readStream.schema(TOPIC_RECORD).option("maxFilesPerTrigger", str(files)).parquet(src)
        return start_split_job(spark, stream, valid_sink, dlq.write_batch, name=f"split-{ck[-6:]}", checkpoint=ck, trigger={"availableNow": True})

    _until_broken(start())
    start().awaitTermination()
    names = ["offset", *[f.name for f in event]]
    out = valid.read(spark).select(*names, F.lit(None).cast("string").alias("dlq_reason")).unionByName(dlq.read(spark).select(*names, "dlq_reason"))
    return out.withColumnRenamed("offset", "event_id")


def q_stream_split_watermark(spark, sf_dir):
    """The order job over two splits of the topic, of which the second lags a quarter of the whole time behind the
    first. Each split has a watermark of its own, so all its orders count; one that a single watermark over
    both would drop is counted, one behind its own split's watermark is not."""
    apply_core_conf(spark)
    srcs, out, ck = [scratch_path(spark, "split-src") for _ in range(2)], scratch_path(spark, "split-out"), scratch_path(spark, "split-ck")
    events = FX.json_events(spark, sf_dir, dense=True, extra=("timestamp",))
    low, high = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    table = KeyedTable(out)
    if low is None:
        return _stats_out(spark.createDataFrame([], USER_ORDER_STATS))
    part = F.least(F.expr(f"(`timestamp` - {low}) * {STREAM_PARTS} div {high - low + 1}"), F.lit(STREAM_PARTS - 1))
    for src in srcs:
        write_values(events.limit(0), src)

    def order(order_id, user_id, ms):
        return spark.range(1).select(encode_order_json(
            order_id=F.lit(order_id), user_id=F.lit(user_id), amount=F.lit(0.0), status=F.lit("PLACED"), timestamp=F.lit(ms)).alias("value"))

    q = (order_stats_plan([read_value_stream(spark, s) for s in srcs], exact=True).writeStream.outputMode("append").foreachBatch(table.write_batch)
         .option("checkpointLocation", ck).start())
    try:
        for step in range(STREAM_PARTS + 1):
            for split, i in ((0, step), (1, step - 1)):
                if 0 <= i < STREAM_PARTS:
                    write_values(events.where((part == i) & (F.col("offset") % 2 == split)), srcs[split])
            q.processAllAvailable()
        write_values(order("late", LATE_USER, low), srcs[0])  # behind both splits by now
        q.processAllAvailable()
        for i in range(2):
            for src in srcs:
                write_values(order(f"end-{i}", SENTINEL_USER, 4102444800000 + i), src)
            q.processAllAvailable()
    finally:
        q.stop()
    return _stats_out(table.read(spark).where(F.col("user_id") != SENTINEL_USER))


def q_stream_dedup_history(spark, sf_dir):
    """Orders whose copies arrive after everything else, far beyond the watermark: the history of keys drops
    them. The last batch breaks off after its rows and is repeated."""
    from orderstream.streaming.dedup_history import DuplicateHistory

    apply_core_conf(spark)
    src, out, ck, keys = (scratch_path(spark, n) for n in ("history-src", "history-out", "history-ck", "history-keys"))
    oe = tag_events(FX.order_events(spark, sf_dir), None).where(F.col("dlq_reason").isNull()).select("order_id", "user_id", "amount", "status", "timestamp", "event_id")
    copies = oe.where(F.col("event_id") % 97 == 0)
    files = 2 * _files_of_a_lot(oe, 4)
    for part in (oe.where(F.col("event_id") % 2 == 0), oe.where(F.col("event_id") % 2 == 1).unionByName(copies), copies.unionByName(copies)):
        _append_lot(part, src, files)
    broken = []

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            raise _Broken("after the rows, before the keys")

    history = DuplicateHistory(spark, keys, f"history_{keys[-8:]}", sink=sink, buckets=8)

    def run():
        stream = spark.readStream.schema(oe.schema).option("maxFilesPerTrigger", str(files)).parquet(src)
        return stream.writeStream.foreachBatch(history.write_batch).option("checkpointLocation", ck).trigger(availableNow=True).start()

    _until_broken(run())
    run().awaitTermination()
    return spark.read.schema(ORDER_EVENT).parquet(out).select(*[f.name for f in ORDER_EVENT.fields])


def q_stream_alert_timeline(spark, sf_dir):
    """The alert rules on the stream of samples, which arrives in four batches of mixed order: the states in the time asked for,
    with holds that began before it."""
    from orderstream.streaming.alert_job import GONE, alert_stream

    apply_core_conf(spark)
    src, out, ck = (scratch_path(spark, n) for n in ("alert-src", "alert-out", "alert-ck"))
    samples = FX.metric_samples(spark, sf_dir).withColumn("ms", F.unix_millis("ts"))
    low, high = samples.agg(F.min("ms"), F.max("ms")).first()
    samples.drop("ms").limit(0).write.parquet(src)
    alerts = alert_stream(read_samples(spark, src, streaming=True))
    q = alerts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").start()
    end = [("end_of_samples", None, None, 4102444800 + i, 0.0) for i in range(2)]  # no rule's metric: closes all windows
    try:
        if low is not None:
            part = F.least(F.expr(f"(ms - {low}) * {STREAM_PARTS} div {high - low + 1}"), F.lit(STREAM_PARTS - 1))
            for i in range(STREAM_PARTS):
                samples.where(part == i).drop("ms").repartition(4).write.mode("append").parquet(src)
                q.processAllAvailable()
        for row in end:
            (spark.createDataFrame([row], "metric string, topic string, instance string, s long, value double")
             .select("metric", "topic", "instance", F.timestamp_seconds("s").alias("ts"), "value").write.mode("append").parquet(src))
            q.processAllAvailable()
    finally:
        q.stop()
    kept = spark.read.schema(alerts.schema).parquet(out).where(F.col("state") != GONE)
    return _alert_out(kept.where(F.col("ts").between(F.lit(ALERT_SINCE).cast("timestamp"), F.lit(ALERT_AT).cast("timestamp"))))


def _median(key, start, end, rows):
    """A user's lower median, spread and number of orders in a window."""
    import pandas as pd

    amounts = sorted(rows["amount"])
    return pd.DataFrame([(key[0], start, end, amounts[(len(amounts) - 1) // 2], amounts[-1] - amounts[0], len(amounts))],
                        columns=["user_id", "window_start", "window_end", "median_amount", "spread", "orders"])


def q_stream_user_medians(spark, sf_dir):
    """A function over all rows of each user's one-minute window: the median amount of the valid PLACED orders. An order
    that comes after its window has closed is dropped."""
    from orderstream.streaming.window_function import window_apply

    apply_core_conf(spark)
    src, out, ck = (scratch_path(spark, n) for n in ("median-src", "median-out", "median-ck"))
    events = FX.json_events(spark, sf_dir, dense=True, extra=("timestamp",))
    write_values(events.limit(0), src)
    watched = with_event_watermark(tagged_events(read_value_stream(spark, src)))
    placed = guarded_filter(watched, F.col("dlq_reason").isNull() & status_is("PLACED"))
    schema = "user_id string, window_start timestamp, window_end timestamp, median_amount double, spread double, orders long"
    q = (window_apply(placed, ["user_id"], ["amount"], _median, schema).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).outputMode("append").start())

    def order(order_id, user_id, ms):
        write_values(spark.range(1).select(encode_order_json(order_id=F.lit(order_id), user_id=F.lit(user_id), amount=F.lit(0.0),
                                                             status=F.lit("PLACED"), timestamp=F.lit(ms)).alias("value")), src)
        q.processAllAvailable()

    try:
        _arrive_in_parts(spark, events, "timestamp", src, q)
        order("late", LATE_USER, FX.EPOCH0_MS)
        for i in range(2):
            order(f"end-{i}", SENTINEL_USER, 4102444800000 + i)
    finally:
        q.stop()
    got = spark.read.schema(schema).parquet(out).where(F.col("user_id") != SENTINEL_USER)
    return got.select("user_id", naive("window_start").alias("window_start"), naive("window_end").alias("window_end"), "median_amount", "spread", "orders")


def q_maintained_totals(spark, sf_dir):
    """Dashboard totals kept up to date over three batches of the result table: half of the orders, then all orders for
    the earlier windows, then all of them with the last batch written twice and the changes folded."""
    oe = _placed_valid(FX.order_events(spark, sf_dir, dense=True))
    table = KeyedTable(scratch_path(spark, "maintained-table"))
    totals = MaintainedTotals(table, scratch_path(spark, "maintained-changes"))
    whole = windowed_stats(oe, exact=True)
    low, high = oe.agg(F.min("timestamp"), F.max("timestamp")).first()
    middle = F.timestamp_millis(F.lit(0 if low is None else (low + high) // 2))
    totals.write_batch(windowed_stats(oe.where(F.col("event_id") % 2 == 0), exact=True), 0)
    totals.write_batch(whole.where(F.col("window_start") < middle), 1)
    totals.compact(spark)
    for _ in range(2):
        totals.write_batch(whole, 2)
    users = totals.by_user(spark).select(F.lit("user").alias("total_of"), F.col("user_id").alias("name"), "order_count", "total_amount")
    windows = totals.by_window(spark).select(F.lit("window").alias("total_of"), F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("name"), "order_count", "total_amount")
    return users.unionByName(windows)


def _arrive_in_parts(spark, df, ms: str, src: str, query) -> None:
    """The rows' values as ``STREAM_PARTS`` data batches in order of the time column ``ms``."""
    low, high = df.agg(F.min(ms), F.max(ms)).first()
    if low is None:
        return
    part = F.least(F.expr(f"(`{ms}` - {low}) * {STREAM_PARTS} div {high - low + 1}"), F.lit(STREAM_PARTS - 1))
    for i in range(STREAM_PARTS):
        write_values(df.where(part == i), src)
        query.processAllAvailable()


def q_stream_dedup_orders(spark, sf_dir):
    """Orders that arrive twice, through streaming duplicate suppression: a copy
    comes within the watermark's delay of its first and is dropped."""
    apply_core_conf(spark)
    src, out, ck = (scratch_path(spark, n) for n in ("dedup-src", "dedup-out", "dedup-ck"))
    orders = FX.order_events_dup(spark, sf_dir)
    json = orders.where(F.col("order_id") != "").select("timestamp", encode_order_json().alias("value"))
    write_values(json.limit(0), src)
    events = with_event_watermark(tagged_events(read_value_stream(spark, src)))
    kept = dedup_streaming(guarded_filter(events, F.col("dlq_reason").isNull()))
    q = (kept.select("order_id", "user_id", "amount", "status", "timestamp").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).outputMode("append").start())
    try:
        _arrive_in_parts(spark, json, "timestamp", src, q)
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(ORDER_EVENT).parquet(out)


def q_stream_dlq_archive(spark, sf_dir):
    """The dead-letter branch of the event stream into the JSON archive, read back."""
    src, out, ck = (scratch_path(spark, n) for n in ("archive-src", "archive-out", "archive-ck"))
    write_values(FX.json_events(spark, sf_dir), src)
    q = dlq_archive(dlq_plan(read_value_stream(spark, src)).select("value", "dlq_reason"), out, ck, trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.schema("value string, dlq_reason string").json(out)


def q_dlq_notifications(spark, sf_dir):
    """Dead-letter alert lines through the notifier's table, written twice as a replay would."""
    path = scratch_path(spark, "alerts")
    sink = AlertSink(table_path=path, webhook_url="")
    lines = q_dlq_alert_text(spark, sf_dir)
    for _ in range(2):
        sink(lines, 0)
    return spark.read.parquet(path).select("offset", "alert_text")


def q_alert_payloads(spark, sf_dir):
    """The webhook bodies of the dead-letter alert lines."""
    return q_dlq_alert_text(spark, sf_dir).select("offset", alert_payload("alert_text").alias("payload"))


def q_parsed_samples(spark, sf_dir):
    """Samples whose value and time travel as text and epoch seconds, parsed."""
    return FX.raw_samples(spark, sf_dir).select("event_id", sample_value("v").alias("value"), naive(from_epoch_s("t")).alias("ts"))


def q_load_summary_file(spark, sf_dir):
    """The load summary written as its JSON file and read back."""
    path = scratch_path(spark, "summary")
    summary = LT.load_summary(FX.send_log(spark, sf_dir))
    write_summary(summary, path)
    return spark.read.schema(summary.schema).json(path)


def q_metric_samples(spark, sf_dir):
    """The whole samples table, written and scanned as the metric operators read it."""
    path = scratch_path(spark, "samples")
    FX.metric_samples(spark, sf_dir).write.parquet(path)
    return _samples_out(read_samples(spark, path))


# ---- load summaries --------------------------------------------------------------

def q_load_summary(spark, sf_dir):
    return LT.load_summary(FX.send_log(spark, sf_dir))


def q_latency_percentiles(spark, sf_dir):
    return LT.latency_percentiles(FX.send_log(spark, sf_dir), exact_money=True)


def q_latency_sketches(spark, sf_dir):
    """Percentiles by request from stored sketches of each request and minute, held against the log: exact counts, and
    whether each estimate's rank is as near as stated."""
    log, path = FX.send_log(spark, sf_dir), scratch_path(spark, "sketches")
    SK.minute_sketches(log).write.parquet(path)
    spans = SK.span_percentiles(spark.read.parquet(path))
    names = [f"p{round(100 * q)}_ms" for q in LT.QUANTILES]
    # per request: how many successful sends lie below each estimate, and not above it
    x = log.where(~F.col("error")).join(spans.select(F.col("request").alias("r"), *names), F.col("request") == F.col("r"))
    ranks = x.groupBy("request").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("duration_ms") < F.col(c)).alias(f"{c}_below") for c in names],
                                     *[F.count_if(F.col("duration_ms") <= F.col(c)).alias(f"{c}_upto") for c in names])
    near = [((F.col(f"{c}_below") / F.col("n") <= q + SK.RANK_ERROR) & (F.col(f"{c}_upto") / F.col("n") >= q - SK.RANK_ERROR)).alias(f"{c}_near")
            for c, q in zip(names, LT.QUANTILES, strict=True)]
    good = ranks.select(F.col("request").alias("r"), *near)
    return spans.join(good, F.col("request") == F.col("r"), "left").select("request", "sends", "errors", *[f"{c}_near" for c in names])


def q_load_summary_sketches(spark, sf_dir):
    """The exact part of the load summary from the mergeable rows of minutes."""
    s = SK.span_summary(SK.minute_sketches(FX.send_log(spark, sf_dir)))
    return s.select("total_messages", "duration_s", "throughput", "error_rate_pct")


def q_slo_check(spark, sf_dir):
    return LT.slo_check(LT.load_summary(FX.send_log(spark, sf_dir)))


def _with_core_conf(fn):
    """Registered queries may run on a session built elsewhere: pin the
    settings their semantics depend on (UTC session zone) before planning."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_core_conf(spark)
        return fn(spark, sf_dir)

    return run


QUERIES = {
    "validate_events": q_validate_events,
    "decode_validate": q_decode_validate,
    "valid_events": q_valid_events,
    "dlq_events": q_dlq_events,
    "dlq_payload": q_dlq_payload,
    "dlq_rate": q_dlq_rate,
    "dlq_rate_by_window": q_dlq_rate_by_window,
    "partitioned_by_user": q_partitioned_by_user,
    "order_stats_1m": q_order_stats_1m,
    "orders_daily_stats": q_orders_daily_stats,
    "top_users": q_top_users,
    "revenue_over_time": q_revenue_over_time,
    "volume_over_time": q_volume_over_time,
    "kpi_top20": q_kpi_top20,
    "kpi_global": q_kpi_global,
    "upsert_latest": q_upsert_latest,
    "dedup_orders": q_dedup_orders,
    "retry_plan": q_retry_plan,
    "retry_outcomes": q_retry_outcomes,
    "retry_permanent_alerts": q_retry_permanent_alerts,
    "dlq_alert_text": q_dlq_alert_text,
    "dlq_roundtrip": q_dlq_roundtrip,
    "metric_latest": q_metric_latest,
    "metric_range": q_metric_range,
    "metric_sum": q_metric_sum,
    "per_instance_latest": q_per_instance_latest,
    "metric_rate_5m": q_metric_rate_5m,
    "metric_increase_5m": q_metric_increase_5m,
    "dlq_rate_sum_range": q_dlq_rate_sum_range,
    "alert_states": q_alert_states,
    "alert_timeline": q_alert_timeline,
    "alert_state_counts": q_alert_state_counts,
    "active_alerts": q_active_alerts,
    "status_bands": q_status_bands,
    "metric_names_parsed": q_metric_names_parsed,
    "stream_order_stats": q_stream_order_stats,
    "stream_retry_release": q_stream_retry_release,
    "stream_retry_continuous": q_stream_retry_continuous,
    "stream_dlq_once": q_stream_dlq_once,
    "stream_split_job": q_stream_split_job,
    "stream_split_watermark": q_stream_split_watermark,
    "stream_dedup_history": q_stream_dedup_history,
    "stream_alert_timeline": q_stream_alert_timeline,
    "stream_user_medians": q_stream_user_medians,
    "maintained_totals": q_maintained_totals,
    "stream_dedup_orders": q_stream_dedup_orders,
    "stream_dlq_archive": q_stream_dlq_archive,
    "dlq_notifications": q_dlq_notifications,
    "alert_payloads": q_alert_payloads,
    "parsed_samples": q_parsed_samples,
    "metric_samples": q_metric_samples,
    "load_summary_file": q_load_summary_file,
    "load_summary": q_load_summary,
    "latency_percentiles": q_latency_percentiles,
    "latency_sketches": q_latency_sketches,
    "load_summary_sketches": q_load_summary_sketches,
    "slo_check": q_slo_check,
}
QUERIES = {k: _with_core_conf(v) for k, v in QUERIES.items()}
