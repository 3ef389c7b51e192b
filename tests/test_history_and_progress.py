"""Copies beyond any watermark, mergeable summaries, and the job's own progress as samples."""

import dataclasses
import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from orderstream.operators import alerts as AL
from orderstream.operators import loadtest as LT
from orderstream.operators import sketches as SK
from orderstream.schema import SEND_LOG
from orderstream.sources.files import read_samples
from orderstream.streaming.dedup_history import DuplicateHistory
from orderstream.streaming.progress_samples import BATCH_MS, FAILURES, LAG_MS, LATE, ROWS, UPTIME_MS, ProgressSamples

T0 = dt.datetime(2024, 1, 1)


def orders(spark, *rows):
    return spark.createDataFrame(rows, "order_id string, timestamp long, note string")


def test_copies_are_found_days_later(spark, tmp_dir):
    out = {}
    h = DuplicateHistory(spark, f"{tmp_dir}/h", "history_a", sink=lambda df, b: out.__setitem__(b, sorted((r[0] or "", r[1]) for r in df.collect())), buckets=4)
    h.write_batch(orders(spark, ("a", 5, ""), ("a", 3, "first"), ("b", 1, ""), (None, 1, ""), (None, 1, "")), 0)
    h.write_batch(orders(spark, ("a", 10**9, ""), ("c", 2, ""), (None, 1, "")), 1)
    h.write_batch(orders(spark, ("a", 10**9, ""), ("c", 2, ""), (None, 1, "")), 1)  # repeated whole
    h.write_batch(orders(spark, ("c", 10**12, ""), ("b", 10**12, "")), 2)
    assert out == {0: [("", 1), ("", 1), ("a", 3), ("b", 1)], 1: [("", 1), ("c", 2)], 2: []}
    # another session's table over the same folder goes on with the same history
    again = DuplicateHistory(spark, f"{tmp_dir}/h", "history_b", buckets=4)
    assert [r[0] for r in again.new_rows(orders(spark, ("a", 1, ""), ("d", 1, "")), 3).collect()] == ["d"]


def test_the_history_does_not_move(spark, tmp_dir):
    h = DuplicateHistory(spark, f"{tmp_dir}/h", "history_c", buckets=4)
    h.write_batch(orders(spark, *[(f"o{i}", i, "") for i in range(400)]), 0)
    h.write_batch(orders(spark, *[(f"o{i}", i, "") for i in range(300, 600)]), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = h.new_rows(orders(spark, *[(f"o{i}", i, "") for i in range(500, 700)]), 2)
        assert new.count() == 100
        lines = new._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "Bucketed: true" in x)
    join = max(i for i, x in enumerate(lines[:scan]) if "Join" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    above = [x for i, x in enumerate(lines[join + 1:scan], join + 1) if depth(x) < depth(lines[scan]) and all(depth(y) >= depth(x) for y in lines[i:scan])]
    assert not any("Exchange" in x for x in above), above


def send_log(spark, n, seed=0, errors=0.1):
    rng = random.Random(seed)
    rows = [(T0 + dt.timedelta(seconds=rng.randrange(600)), 100, rng.choice([rng.gauss(50, 10), rng.expovariate(0.01), 7.0]), rng.random() < errors) for _ in range(n)]
    return spark.createDataFrame(rows, SEND_LOG).withColumn("request", F.when(F.second("ts") % 2 == 0, "even").otherwise("odd")), rows


def rank_near(values, got, q):
    below, upto = sum(v < got for v in values) / len(values), sum(v <= got for v in values) / len(values)
    return below <= q + SK.RANK_ERROR and upto >= q - SK.RANK_ERROR


@pytest.mark.parametrize("n", [1, 30, 6000])
def test_merged_sketches_are_near(spark, tmp_dir, n):
    log, rows = send_log(spark, n, errors=0 if n == 1 else 0.1)
    SK.minute_sketches(log).write.parquet(f"{tmp_dir}/m")
    stored = spark.read.parquet(f"{tmp_dir}/m")
    assert stored.count() <= 20
    whole = SK.span_summary(stored).first().asDict()
    exact = LT.load_summary(log).first().asDict()
    values = [r[2] for r in rows if not r[3]]
    for q, c in zip(LT.QUANTILES, ("p50_ms", "p95_ms", "p99_ms"), strict=True):
        assert rank_near(values, whole.pop(c), q)
        exact.pop(c)
    assert whole == exact
    since, until = T0 + dt.timedelta(minutes=2), T0 + dt.timedelta(minutes=5)
    for r in SK.span_percentiles(stored, since=since, until=until).collect():
        own = [x[2] for x in rows if since <= x[0] < until and not x[3] and (x[0].second % 2 == 0) == (r["request"] == "even")]
        assert not own and r["p50_ms"] is None or all(rank_near(own, r[c], q) for q, c in zip(LT.QUANTILES, ("p50_ms", "p95_ms", "p99_ms"), strict=True))


def test_summaries_of_nothing_and_of_errors(spark):
    none, _ = send_log(spark, 0)
    x = SK.span_summary(SK.minute_sketches(none)).first()
    assert x["total_messages"] == 0 and x["p99_ms"] is None and x["error_rate_pct"] is None
    bad, _ = send_log(spark, 5, errors=2.0)
    x = SK.span_summary(SK.minute_sketches(bad)).first()
    assert x["total_messages"] == 0 and x["p50_ms"] is None and x["error_rate_pct"] == 100.0


def test_progress_becomes_samples_and_fires_a_rule(spark, tmp_dir):
    listener = ProgressSamples(spark, f"{tmp_dir}/samples", lot=5)
    spark.streams.addListener(listener)
    slow = lambda df, b: (df.collect(), time.sleep(0.8))

    def start(name, sink):
        spark.range(3).select(F.col("id").cast("string").alias("value"), F.timestamp_seconds(F.col("id") * 10).alias("t")).write.mode("append").parquet(f"{tmp_dir}/in-{name}")
        stream = spark.readStream.schema("value string, t timestamp").parquet(f"{tmp_dir}/in-{name}").withWatermark("t", "5 seconds")
        return stream.groupBy(F.window("t", "10 seconds")).count().writeStream.queryName(name).option("checkpointLocation", f"{tmp_dir}/ck-{name}").foreachBatch(sink).start()

    def fails(df, b):
        raise RuntimeError("no")

    try:
        q = start("slow_job", slow)
        q.processAllAvailable()
        q.stop()
        bad = start("bad_job", fails)
        with pytest.raises(Exception):
            bad.processAllAvailable()
        for _ in range(100):
            if "bad_job" in listener.failed and any(r[0] == BATCH_MS for r in listener.rows) or listener.rows == []:
                break
            time.sleep(0.1)
        time.sleep(1)
        listener.flush()
    finally:
        spark.streams.removeListener(listener)
    samples = read_samples(spark, f"{tmp_dir}/samples")
    by = {}
    for r in samples.collect():
        by.setdefault((r["metric"], r["instance"]), []).append(r["value"])
    assert max(by[BATCH_MS, "slow_job"]) >= 800 and sum(by[ROWS, "slow_job"]) == 3 and max(by[UPTIME_MS, "slow_job"]) > 0
    assert by[FAILURES, "slow_job"][-1] == 0 and max(by[FAILURES, "bad_job"]) == 1 and min(by[UPTIME_MS, "bad_job"]) == 0
    assert (LATE, "slow_job") in by and (LAG_MS, "slow_job") in by
    rules = [dataclasses.replace(r, threshold=700.0, for_s=0) if r.alert == "FlinkCheckpointDurationHigh" else dataclasses.replace(r, for_s=0) for r in AL.DEFAULT_RULES]
    firing = {(r["alert"], r["instance"]) for r in AL.alert_timeline(samples, rules).where("state = 'firing'").collect()}
    assert ("FlinkCheckpointDurationHigh", "slow_job") in firing and ("FlinkJobNotRunning", "bad_job") in firing
