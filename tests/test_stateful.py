"""Alerts on a stream, functions over windows, and totals that are kept up to date."""

import datetime as dt
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderstream.operators.alerts import AlertRule, alert_timeline
from orderstream.operators.maintained import MaintainedTotals
from orderstream.operators.windows import with_event_watermark
from orderstream.schema import METRIC_SAMPLE, USER_ORDER_STATS
from orderstream.sources.tables import KeyedTable
from orderstream.streaming.alert_job import SeriesState, alert_stream
from orderstream.streaming.window_function import window_apply

T0 = dt.datetime(2024, 1, 1)
HIGH = AlertRule("High", "m", ">", 10, 30, "warning", "high")
GROWS = AlertRule("Grows", "m", ">", 0, 0, "critical", "grows", "increase", 60)


def states(s, until):
    return [(r.alert, ms, st, since) for r, ms, _, st, since in s.take(until)]


def test_hold_times_survive_batches_and_gaps_end_them():
    s = SeriesState([HIGH], 300_000, None)
    for ms, v in ((0, 11.0), (15_000, 12.0), (30_000, 11.0)):
        s.arrive(ms, v)
    assert states(s, 15_000) == [("High", 0, "pending", 0), ("High", 15_000, "pending", 0)]
    s = SeriesState([HIGH], 300_000, s.stored())  # the next batch, from the store
    assert states(s, 10**9) == [("High", 30_000, "firing", 0)]
    s.arrive(30_000, 99.0)  # the sample is there already
    s.arrive(20_000, 99.0)  # late
    s.arrive(331_000, 11.0)  # after more than the staleness: a new hold
    assert states(s, 10**9) == [("High", 331_000, "pending", 331_000)]
    s.arrive(340_000, None)
    s.arrive(341_000, float("nan"))
    s.arrive(342_000, 11.0)
    assert [x[2:] for x in states(s, 10**9)] == [("inactive", None), ("inactive", None), ("pending", 342_000)]
    assert s.gone_at() == 642_000 and s.active() == [HIGH]


def test_stream_equals_timeline(spark, tmp_dir):
    """Samples in mixed order within the delay, with gaps, resets, silent series and rules of each kind."""
    rng, rows = random.Random(4), []
    rules = [HIGH, GROWS, AlertRule("Zero", "m", "==", 0, 15, "", "zero"), AlertRule("Rate", "c", ">", 0.5, 20, "critical", "rate", "rate", 45, "t1"),
             AlertRule("None", "unused", ">", 0, 0, "info", "-")]
    for metric, topic, instance in (("m", None, "a"), ("m", None, "b"), ("c", "t1", "a"), ("c", "t2", "a"), ("c", "t1", None), ("other", None, "a")):
        t, v = 0, 0.0
        for _ in range(120):
            t += rng.choice([15, 15, 15, 16, 400 if rng.random() < 0.05 else 15])
            v = rng.choice([0.0, 5.0, 20.0]) if metric == "m" else rng.choice([v, v + 10, v + 40, 0.0])
            rows.append((metric, topic, instance, T0 + dt.timedelta(seconds=t), v))
    rows.sort(key=lambda r: r[3])
    for i in range(0, len(rows), 6):  # neighbours change places
        part = rows[i:i + 6]
        rng.shuffle(part)
        rows[i:i + 6] = part
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    end = [("other", None, "z", T0 + dt.timedelta(days=9, seconds=i), 0.0) for i in range(2)]
    spark.createDataFrame(rows[:100], METRIC_SAMPLE).write.parquet(src)
    stream = alert_stream(spark.readStream.schema(METRIC_SAMPLE).parquet(src), rules, delay="2 minutes")
    start = lambda: stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_dir}/ck").start()
    q = start()
    q.processAllAvailable()
    q.stop()  # and on from the checkpoint
    q = start()
    for part in (rows[100:350], rows[350:], end[:1], end[1:]):
        spark.createDataFrame(part, METRIC_SAMPLE).repartition(2).write.mode("append").parquet(src)
        q.processAllAvailable()
    q.stop()
    names = ["alert", "metric", "topic", "instance", "ts", "value", "state", "active_at", "severity", "summary"]
    got = spark.read.schema(stream.schema).parquet(out)
    want = alert_timeline(spark.createDataFrame(rows, METRIC_SAMPLE), rules)
    key = lambda r: tuple(map(str, r))
    a = sorted((tuple(r) for r in got.where("state <> 'gone'").select(*names).collect()), key=key)
    b = sorted((tuple(r) for r in want.select(*names).collect()), key=key)
    assert a == b and {r[6] for r in a} == {"inactive", "pending", "firing"}
    # a series that goes silent ends its alerts once: 5 minutes after its last sample
    gone = sorted((r["alert"], r["instance"] or "", r["ts"]) for r in got.where("state = 'gone'").collect())
    lasts = {}
    for r in sorted(b, key=lambda r: r[4]):
        lasts[r[0], r[3] or ""] = r
    assert set(gone) >= {(k[0], k[1], r[4] + dt.timedelta(minutes=5)) for k, r in lasts.items() if r[6] != "inactive"}


def _event_stream(spark, path):
    return with_event_watermark(spark.readStream.schema("k string, event_time timestamp, v double, note string").json(path))


def _put(spark, path, *rows):
    df = spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s), v, n) for k, s, v, n in rows], "k string, event_time timestamp, v double, note string")
    df.write.mode("append").json(path)


def test_window_functions_see_all_rows_once(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _put(spark, src, ("a", 0, 1.0, "x"), ("a", 59.999, 5.0, None), ("b", 10, 2.0, "y"))
    schema = "k string, start timestamp, end timestamp, median double, notes string"

    def middle(key, start, end, rows):
        return pd.DataFrame([(key[0], start, end, statistics.median(rows["v"].dropna()), ",".join(sorted(str(n) for n in rows["note"])))],
                            columns=["k", "start", "end", "median", "notes"])

    def run(*batches):
        q = (window_apply(_event_stream(spark, src), ["k"], ["v", "note"], middle, schema).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).start())
        try:
            q.processAllAvailable()
            for rows in batches:
                _put(spark, src, *rows)
                q.processAllAvailable()
        finally:
            q.stop()

    run([("c", 63, 1.0, "z")], [("a", 30, 3.0, "older than the watermark, window open")])
    run([("c", 70, 4.0, "z2")], [("a", 2, 9.0, "late")], [("end", 1000, 0.0, "")], [("end", 1001, 0.0, "")])
    got = {(r["k"], r["start"].second + 60 * r["start"].minute, r["median"], r["notes"]) for r in spark.read.parquet(out).where("k <> 'end'").collect()}
    assert got == {("a", 0, 3.0, "None,older than the watermark, window open,x"), ("b", 0, 2.0, "y"), ("c", 60, 2.5, "z,z2")}


def _stats(spark, *rows):
    return spark.createDataFrame([(u, n, a, T0 + dt.timedelta(days=d), T0 + dt.timedelta(days=d, minutes=1)) for u, n, a, d in rows], USER_ORDER_STATS)


def _totals(t, spark):
    return ({r[0]: (r[1], r[2]) for r in t.by_user(spark).collect()}, {(r[0] - T0).days: (r[1], r[2]) for r in t.by_window(spark).collect()})


def test_totals_follow_overwrites(spark, tmp_dir):
    t = MaintainedTotals(KeyedTable(f"{tmp_dir}/table"), f"{tmp_dir}/changes")
    assert _totals(t, spark) == ({}, {})
    t.write_batch(_stats(spark, ("a", 2, 10.1, 0), ("b", 1, 0.1, 0), ("a", 1, 0.2, 1)), 0)
    assert _totals(t, spark) == ({"a": (3, 10.3), "b": (1, 0.1)}, {0: (3, 10.2), 1: (1, 0.2)})
    change = _stats(spark, ("a", 5, 20.0, 0), ("c", 1, 0.3, 2))
    t.write_batch(change, 1)
    want = ({"a": (6, 20.2), "b": (1, 0.1), "c": (1, 0.3)}, {0: (6, 20.1), 1: (1, 0.2), 2: (1, 0.3)})
    assert _totals(t, spark) == want
    t.compact(spark)
    assert _totals(t, spark) == want
    t.write_batch(change, 1)  # replayed after compaction
    assert _totals(t, spark) == want
    t.write_batch(_stats(spark, ("b", 0, 0.0, 0)), 2)  # taken back whole
    assert _totals(t, spark) == ({"a": (6, 20.2), "c": (1, 0.3)}, {0: (5, 20.0), 1: (1, 0.2), 2: (1, 0.3)})
    t.compact(spark)
    t.compact(spark)
    assert _totals(t, spark)[0] == {"a": (6, 20.2), "c": (1, 0.3)}


def test_a_batch_reads_the_dates_it_touches(spark, tmp_dir):
    t = MaintainedTotals(KeyedTable(f"{tmp_dir}/table"), f"{tmp_dir}/changes")
    t.write_batch(_stats(spark, *[("a", 1, 1.0, d) for d in range(30)]), 0)
    plan = t.before(_stats(spark, ("a", 2, 1.0, 7)), 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-08" in plan.replace("19730", "2024-01-08")
    assert t.before(_stats(spark, ("a", 2, 1.0, 7)), 1).count() == 1


@pytest.mark.parametrize("seed", [1])
def test_totals_equal_the_table(spark, tmp_dir, seed):
    rng = random.Random(seed)
    table = KeyedTable(f"{tmp_dir}/table")
    t = MaintainedTotals(table, f"{tmp_dir}/changes")
    for b in range(4):
        rows = {(rng.choice("abcd"), rng.randrange(4)): (rng.randrange(1, 5), rng.randrange(1000) / 100) for _ in range(8)}
        t.write_batch(_stats(spark, *[(u, n, a, d) for (u, d), (n, a) in rows.items()]), b)
        if b == 2:
            t.compact(spark)
    now = table.read(spark)
    for column, got in (("user_id", t.by_user(spark)), ("window_start", t.by_window(spark))):
        want = now.groupBy(column).agg(F.sum("order_count"), F.sum(F.col("total_amount").cast("decimal(18,2)")).cast("double"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
