"""Job wiring (valid + dead-letter branches), file sinks, alert sink, streaming dedup."""

import json
import os

from pyspark.sql import functions as F

from orderstream.functions.scalar import from_epoch_s, sample_value
from orderstream.sources.files import dlq_archive, read_value_stream
from orderstream.sources.notify import AlertSink
from orderstream.sources.tables import KeyedTable
from orderstream.streaming.job import dlq_plan, order_stats_plan, start_order_job


def _ev(ts, amount, user="u1", order=None, status="PLACED"):
    return json.dumps({"order_id": order if order is not None else f"o{ts}", "user_id": user,
                       "amount": amount, "status": status, "timestamp": ts})


def _write(src, i, lines):
    with open(os.path.join(src, f"{i:03d}.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_job_routes_valid_and_dead_letter(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    stats, dlq_path = KeyedTable(os.path.join(tmp_dir, "stats")), os.path.join(tmp_dir, "dlq")

    def dlq_sink(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(dlq_path)

    values = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)
    qs = start_order_job(spark, values, stats.write_batch, dlq_sink, name="t",
                         checkpoint=os.path.join(tmp_dir, "ck"), trigger={"processingTime": "0 seconds"})
    try:
        batches = [[_ev(1000, 5.0), _ev(2000, 7.0), _ev(3000, -2.0), "{bad", _ev(4000, 1.0, user="")],
                   [_ev(10**12, 0.0, user="end")], [_ev(10**12, 0.0, user="end", order="e2")]]
        for i, b in enumerate(batches):
            _write(src, i, b)
            for q in qs:
                q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    cur = {r["user_id"]: (r["order_count"], r["total_amount"]) for r in stats.read(spark).collect()}
    assert cur == {"u1": (2, 12.0)}
    reasons = sorted(r["dlq_reason"] for r in spark.read.parquet(dlq_path).collect())
    assert reasons == ["MALFORMED_JSON", "MISSING_USER_ID", "NEGATIVE_AMOUNT"]
    raw = [r["value"] for r in spark.read.parquet(dlq_path).where("dlq_reason = 'MALFORMED_JSON'").collect()]
    assert raw == ["{bad"]


def test_dlq_archive_file_sink(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(src, 0, [_ev(1, -1.0), _ev(2, 3.0), _ev(3, 4.0, order="")])
    q = dlq_archive(dlq_plan(read_value_stream(spark, src)), os.path.join(tmp_dir, "arch"),
                    os.path.join(tmp_dir, "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    got = sorted(r["dlq_reason"] for r in spark.read.json(os.path.join(tmp_dir, "arch")).collect())
    assert got == ["MISSING_ORDER_ID", "NEGATIVE_AMOUNT"]


def test_alert_sink_table_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "alerts")
    sink = AlertSink(table_path=path, webhook_url="")
    df = spark.createDataFrame([("a",), ("b",)], "alert_text string")
    sink(df, 7)
    sink(df, 7)
    assert spark.read.parquet(path).count() == 2


def test_streaming_dedup_within_watermark(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    out = KeyedTable(os.path.join(tmp_dir, "out"))
    plan = order_stats_plan(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src), dedup=True)
    q = (plan.writeStream.outputMode("append").foreachBatch(out.write_batch)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).start())
    try:
        for i, b in enumerate([[_ev(1000, 5.0, order="x"), _ev(1500, 5.0, order="x")],
                               [_ev(2000, 5.0, order="x"), _ev(3000, 2.0, order="y")],
                               [_ev(10**12, 0.0, user="end")], [_ev(10**12, 0.0, user="end", order="e2")]]):
            _write(src, i, b)
            q.processAllAvailable()
    finally:
        q.stop()
    cur = {r["user_id"]: (r["order_count"], r["total_amount"]) for r in out.read(spark).collect()}
    assert cur == {"u1": (2, 7.0)}


def test_sample_parsing(spark):
    df = spark.createDataFrame([("12.5", 1704067200.5), ("NaN", 0.0), ("x", 1.0)], "v string, t double")
    rows = df.select(sample_value("v").alias("v"), from_epoch_s("t").alias("ts")).collect()
    assert rows[0]["v"] == 12.5 and rows[0]["ts"].microsecond == 500000
    assert rows[1]["v"] != rows[1]["v"] and rows[2]["v"] is None


def _file_sender(path):
    def send(text):
        with open(path, "a") as f:
            f.write(text.replace("\n", "\\n") + "\n")
        if text == "boom":
            raise RuntimeError("send failed")  # must be logged, never fail the job
    return send


def test_alert_sink_sends_from_executors(spark, tmp_dir):
    out = os.path.join(tmp_dir, "sent.txt")
    sink = AlertSink(sender=_file_sender(out))
    df = spark.createDataFrame([("a\nb",), ("boom",), ("c",)], "alert_text string").repartition(3)
    sink(df, 0)
    with open(out) as f:
        assert sorted(f.read().splitlines()) == ["a\\nb", "boom", "c"]


def test_console_samples_and_summary(spark, tmp_dir):
    from orderstream.sources.files import console, read_samples, write_summary

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(src, 0, ["to-the-console"])
    q = console(read_value_stream(spark, src), os.path.join(tmp_dir, "ck"))
    q.processAllAvailable()
    q.stop()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1 and q.exception() is None

    s = spark.createDataFrame([("m", None, "i", 1.5)], "metric string, topic string, instance string, value double").select(
        "metric", "topic", "instance", F.timestamp_seconds(F.lit(5)).alias("ts"), "value")
    path = os.path.join(tmp_dir, "samples")
    s.write.parquet(path)
    assert read_samples(spark, path).collect() == s.collect()
    assert read_samples(spark, path, streaming=True).isStreaming

    write_summary(s.select("metric", "value"), os.path.join(tmp_dir, "sum"))
    assert [tuple(r) for r in spark.read.json(os.path.join(tmp_dir, "sum")).select("metric", "value").collect()] == [("m", 1.5)]


def test_job_sets_the_state_store_before_it_starts(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(src, 0, [_ev(1000, 5.0)])
    new = spark.newSession()
    name = "spark.sql.streaming.stateStore.providerClass"
    values = new.readStream.format("text").load(src)
    qs = start_order_job(new, values, KeyedTable(os.path.join(tmp_dir, "out")).write_batch, name="conf",
                         checkpoint=os.path.join(tmp_dir, "ck"), trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
    assert "RocksDB" in new.conf.get(name)
    with open(os.path.join(tmp_dir, "ck", "stats", "offsets", "0")) as f:
        assert "RocksDBStateStoreProvider" in f.read()
