"""Counter rate/increase edges, range grid, alert hold time, load summaries."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderstream.operators import alerts as AL
from orderstream.operators import loadtest as LT
from orderstream.operators import metrics as M
from orderstream.schema import METRIC_SAMPLE

T0 = 1704067200  # seconds


def _samples(spark, series):
    rows = []
    for name, pts in series.items():
        for t, v in pts:
            rows.append(("c", name, "i", t, float(v)))
    df = spark.createDataFrame(rows, "metric string, topic string, instance string, t long, value double")
    return df.select("metric", "topic", "instance", F.timestamp_seconds(F.col("t") + T0).alias("ts"), "value")


def _by_topic(df, col):
    out = {}
    for r in df.orderBy("topic", "ts").collect():
        out.setdefault(r["topic"], []).append(r[col])
    return out


def test_rate_edges(spark):
    s = _samples(spark, {
        "const": [(0, 5), (15, 5), (30, 5)],
        "rise": [(0, 0), (15, 10), (30, 30)],
        "reset": [(0, 10), (15, 20), (30, 3)],
        "gap": [(0, 0), (15, 10), (400, 50), (415, 60)],
        "single": [(0, 7)],
    })
    inc = _by_topic(M.increase(s, 300), "increase")
    assert inc["const"] == [0, 0, 0]
    assert inc["rise"] == [0, 10, 30]
    assert inc["reset"] == [0, 10, 13]
    assert inc["gap"] == [0, 10, 0, 10]          # the jump across the gap is outside every window
    assert inc["single"] == [0]
    r = _by_topic(M.rate(s, 300), "rate")
    assert r["rise"][-1] == 30 / 300


def test_rate_on_the_grid_and_its_sum(spark):
    s = _samples(spark, {"a": [(0, 0), (15, 30), (30, 60)], "b": [(7, 5), (22, 8), (37, 2)], "lone": [(0, 4)]})
    start, end = "2024-01-01 00:00:00", "2024-01-01 00:06:00"
    g = M.increase_range(s, start, end, 15, 300)
    of = lambda topic: {int(r["ts"].timestamp()) - T0: r["value"] for r in g.where(F.col("topic") == topic).collect()}
    a, b = of("a"), of("b")
    assert a[15] == 30 and a[30] == a[285] == 60 and a[300] == 30  # at 300 s the sample at 0 has left the window
    assert max(a) == 300 and b[30] == 3 and b[45] == 5 and b[315] == 2 and max(b) == 315
    assert of("lone") == {}
    total = {int(r["ts"].timestamp()) - T0: r["value"] for r in M.sum_rate_range(s, start, end, 15, 300).collect()}
    assert total[45] == (60 + 5) / 300 and total[15] == 30 / 300
    r = M.rate_range(s, start, end).where("topic = 'a'").orderBy("ts").first()
    assert r["value"] == 30 / 300


def test_bounded_rate_equals_unbounded(spark):
    s = _samples(spark, {"a": [(t * 15, t * t) for t in range(80)]})
    whole = M.increase(s, 300).where(F.col("ts") >= F.timestamp_seconds(F.lit(T0 + 600)))
    part = M.increase(s, 300, start="2024-01-01 00:10:00", end="2024-01-01 00:20:00")
    assert sorted(whole.select("ts", "increase").collect()) == sorted(part.select("ts", "increase").collect())


def test_range_grid_and_lookback(spark):
    s = _samples(spark, {"a": [(0, 1), (40, 2)], "b": [(20, 9)]})
    start, end = "2024-01-01 00:00:00", "2024-01-01 00:06:00"
    g = M.range_query(s, start, end, step_s=15, lookback_s=300)
    a = [(int(r["ts"].timestamp()) - T0, r["value"]) for r in g.where("topic='a'").orderBy("ts").collect()]
    assert a[:4] == [(0, 1.0), (15, 1.0), (30, 1.0), (45, 2.0)]
    assert a[-1][0] == 330  # sample at 40 s is stale after 340 s
    b = [int(r["ts"].timestamp()) - T0 for r in g.where("topic='b'").orderBy("ts").collect()]
    assert b[0] == 30 and b[-1] == 315


def test_instant_and_per_instance(spark):
    s = _samples(spark, {"a": [(0, 1), (40, 2), (500, 3)]})
    got = M.instant(s, "2024-01-01 00:01:00").collect()
    assert len(got) == 1 and got[0]["value"] == 2.0
    stale = M.instant(s, "2024-01-01 00:07:00").collect()
    assert stale == []


def _gauge(spark, pts):
    rows = [("g", None, "i", T0 + t, float(v)) for t, v in pts]
    df = spark.createDataFrame(rows, "metric string, topic string, instance string, t long, value double")
    return df.select("metric", "topic", "instance", F.timestamp_seconds("t").alias("ts"), "value")


RULE = AL.AlertRule("HoldTwoMinutes", "g", ">", 10, 120, "warning", "test")


def test_alert_hold_boundaries(spark):
    for held, expected in ((119, "pending"), (120, "firing"), (121, "firing")):
        s = _gauge(spark, [(0, 5), (1, 11), (1 + held, 11)])
        st = AL.alert_states(s, [RULE]).first()
        assert st["state"] == expected, held
    eq = AL.alert_states(_gauge(spark, [(0, 10), (200, 10)]), [RULE]).first()
    assert eq["state"] == "inactive"            # threshold equality is not '>'


def test_alert_flapping_resets(spark):
    s = _gauge(spark, [(0, 11), (60, 11), (90, 5), (100, 11), (200, 11)])
    tl = AL.alert_timeline(s, [RULE]).orderBy("ts").collect()
    assert [r["state"] for r in tl] == ["pending", "pending", "inactive", "pending", "pending"]
    assert tl[-1]["active_at"].timestamp() == T0 + 100
    counts = AL.state_counts(AL.alert_states(s, [RULE])).first()
    assert (counts["firing"], counts["pending"], counts["inactive"]) == (0, 1, 0)
    assert tl[0]["severity"] == "warning"


def test_alerts_at_a_time_know_gone_series(spark):
    s = _gauge(spark, [(0, 11), (60, 11), (130, 11)])
    at = lambda t: AL.alert_states(s, [RULE], at=F_ts(t)).collect()
    assert [r["state"] for r in at(100)] == ["pending"] and [r["state"] for r in at(131)] == ["firing"]
    assert [r["state"] for r in at(429)] == ["firing"] and at(430) == []  # 300 s old: the series has gone
    assert [r["state"] for r in AL.alert_states(s, [RULE]).collect()] == ["firing"]


def F_ts(t):
    import datetime as dt

    return dt.datetime.fromtimestamp(T0 + t, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def test_labels_beyond_the_usual_keep_series_apart(spark):
    rows = [("c", None, "i", job, T0 + t, float(v)) for job, pts in
            {"x": [(0, 0), (10, 1), (20, 2)], "y": [(5, 100), (15, 100), (25, 100)]}.items() for t, v in pts]
    df = spark.createDataFrame(rows, "metric string, topic string, instance string, job string, t long, value double")
    s = df.select("metric", "topic", "instance", "job", F.timestamp_seconds("t").alias("ts"), "value")
    rule = AL.AlertRule("Grows", "c", ">", 1.5, 0, "warning", "grows", "increase", 300)
    series = ("metric", "topic", "instance", "job")
    got = {r["job"]: (r["value"], r["state"]) for r in AL.alert_states(s, [rule], series=series).collect()}
    assert got == {"x": (2.0, "firing"), "y": (0.0, "inactive")}


def test_shipped_rules_as_written(spark):
    """The shipped rules against expectations written by hand, not taken from the rule list."""
    one = {
        "KafkaHighProducerLatency": ("kafka_network_request_metrics_produce_total_time_ms_p99", None, [(0, 11), (120, 11)], "warning"),
        "KafkaUnderReplicatedPartitions": ("kafka_server_replica_manager_under_replicated_partitions", None, [(0, 1), (60, 1)], "critical"),
        "KafkaOfflinePartitions": ("kafka_controller_offline_partitions_count", None, [(0, 1), (60, 1)], "critical"),
        "KafkaNoActiveController": ("kafka_controller_active_controller_count", None, [(0, 0), (60, 0)], "critical"),
        "FlinkCheckpointFailed": ("flink_jobmanager_job_numberOfFailedCheckpoints", None, [(0, 0), (15, 1), (150, 2), (280, 3), (315, 4)], "critical"),
        "FlinkCheckpointDurationHigh": ("flink_jobmanager_job_lastCheckpointDuration", None, [(0, 60001), (150, 60001), (300, 60001)], "warning"),
        "FlinkJobNotRunning": ("flink_jobmanager_job_uptime", None, [(0, 0), (120, 0)], "critical"),
        "DLQEventsDetected": ("kafka_server_broker_topic_metrics_messages_in_total", "order-events-dlq", [(0, 0), (15, 1), (150, 2), (315, 3)], "warning"),
        "DLQHighRate": ("kafka_server_broker_topic_metrics_messages_in_total", "order-events-dlq", [(400, 0), (415, 4000), (535, 9000)], "critical"),
    }
    rows = [(m, t, name, T0 + x, float(v)) for name, (m, t, pts, _) in one.items() for x, v in pts]
    df = spark.createDataFrame(rows, "metric string, topic string, instance string, t long, value double")
    s = df.select("metric", "topic", "instance", F.timestamp_seconds("t").alias("ts"), "value")
    firing = {(r["alert"], r["instance"]): r["severity"] for r in AL.alert_states(s).where("state = 'firing'").collect()}
    assert {a: firing.get((a, a)) for a in one} == {a: severity for a, (*_, severity) in one.items()}


def test_exact_percentiles_split_and_interpolate(spark):
    import random

    import numpy as np

    from orderstream.operators.percentiles import exact_percentiles

    rnd = random.Random(1)
    rows = [("hot", float(rnd.randint(0, 300))) for _ in range(3000)] + [("b", rnd.random()) for _ in range(7)] + [("one", 4.0), ("none", None), (None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["n"], r["p0"], r["p1"], r["p2"]) for r in exact_percentiles(df, "v", ["k"], (0.5, 0.95, 0.99)).collect()}
    assert set(got) == {"hot", "b", "one", None}
    for k in got:
        v = [x for g, x in rows if g == k and x is not None]
        assert got[k][0] == len(v)
        np.testing.assert_allclose(got[k][1:], np.quantile(v, (0.5, 0.95, 0.99)), rtol=1e-12)


def test_money_sums_keep_every_amount(spark):
    from orderstream.operators.windows import windowed_stats

    rows = [("nan", float("nan")), ("nan", 1.0), ("cent", 0.005), ("cent", 0.001), ("large", 1e17), ("large", 1.0)]
    df = spark.createDataFrame(rows, "user_id string, amount double").withColumn("event_time", F.timestamp_seconds(F.lit(T0)))
    got = {r["user_id"]: (r["order_count"], r["total_amount"]) for r in windowed_stats(df).collect()}
    assert got["nan"][0] == 2 and got["nan"][1] != got["nan"][1]
    assert got["cent"] == (2, 0.006) and got["large"] == (2, 1e17 + 1.0)


def test_load_summary_and_slo(spark):
    rows = [(T0 + i, "r", 100, float(i), i == 9) for i in range(10)]
    log = spark.createDataFrame(rows, "t long, request string, batch_size int, duration_ms double, error boolean")
    log = log.select(F.timestamp_seconds("t").alias("ts"), "request", "batch_size", "duration_ms", "error")
    s = LT.load_summary(log).first()
    assert s["total_messages"] == 900 and s["duration_s"] == 9.0 and s["throughput"] == 100
    assert s["p50_ms"] == 4.0 and s["error_rate_pct"] == 10.0
    slo = {r["profile"]: r["passed"] for r in LT.slo_check(LT.load_summary(log)).collect()}
    assert slo == {"low": False, "default": False, "high": False, "stress": False}
    approx = LT.load_summary(log, exact=False).first()
    assert approx["p50_ms"] == 4.0


def test_time_range_reaches_the_scan(spark, tmp_dir):
    from conftest import SF001
    from orderstream.plans.fixtures import metric_samples

    path = f"{tmp_dir}/samples"
    metric_samples(spark, SF001).write.parquet(path)
    s = spark.read.parquet(path)
    for df in (M.range_query(s, "2024-01-01 00:20:00", "2024-01-01 00:35:00"),
               M.instant(s, "2024-01-01 00:30:00")):
        txt = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        pushed = [l for l in txt.split("\n") if "PushedFilters" in l][0]
        assert "LessThanOrEqual(ts" in pushed and "GreaterThan(ts" in pushed


def _long_series(spark, seed):
    """Series of many blocks with gaps around the staleness and the range, resets, missing values and holds over several blocks."""
    rng, rows = random.Random(seed), []
    for metric, topic, instance in (("m", None, "a"), ("c", "t", "a"), ("c", None, None)):
        t, v = 0, 0.0
        for _ in range(220):
            t += rng.choice([15_000, 15_000, 15_001, 60_000, 299_999, 300_000, 300_001] if rng.random() < 0.3 else [15_000])
            v = rng.choice([20.0, 20.0, 20.0, 5.0]) if metric == "m" else rng.choice([v, v + 10, v + 40, 0.0])
            rows.append((metric, topic, instance, dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=t), v))
    return spark.createDataFrame(rows, METRIC_SAMPLE), dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=t)


@pytest.mark.parametrize("block_s", [45, 1000])
def test_blocks_change_nothing(spark, block_s):
    samples, end = _long_series(spark, block_s)
    rules = [AL.AlertRule("High", "m", ">", 10, 600, "warning", "-"), AL.AlertRule("Grows", "c", ">", 0, 60, "critical", "-", "increase", 300),
             AL.AlertRule("Rate", "c", ">", 0.1, 0, "critical", "-", "rate", 120, "t"), AL.AlertRule("Still", "c", "==", 0, 0, "info", "-", "increase", 120)]
    start = "2024-01-01 00:02:00"
    whole = 10 ** 6
    calls = [lambda b: M.range_query(samples, start, end, block_s=b), lambda b: M.increase(samples, 300, block_s=b), lambda b: M.rate(samples, 120, start=start, end=end, block_s=b),
             lambda b: M.increase_range(samples, start, end, block_s=b), lambda b: AL.alert_timeline(samples, rules, block_s=b),
             lambda b: AL.alert_timeline(samples, rules, since=start, at=end, block_s=b)]
    for call in calls:
        got, want = (sorted((tuple(r) for r in call(b).collect()), key=repr) for b in (block_s, whole))
        assert got == want and got


def test_latest_by_instance_picks_live_and_newest_series(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [("m", "t", "a", at(0), 1.0), ("m", "t", "a", at(400), 2.0), ("m", "t", "a", at(700), 9.0), ("m", "u", "a", at(450), 3.0), ("m", "t", "old", at(100), 4.0),
            ("m", "t", None, at(390), 5.0), ("m", "t", "", at(390), 6.0), ("m", "v", "", at(390), 7.0), ("x", "t", "b", at(400), 8.0)]
    samples = spark.createDataFrame(rows, METRIC_SAMPLE)
    out = lambda **k: sorted((r["instance"], (r["ts"] - at(0)).seconds, r["value"]) for r in M.latest_by_instance(samples, "m", **k).collect())
    assert out(at=at(500)) == [("a", 450, 3.0), ("unknown", 390, 5.0)]
    assert out(at=at(500), topic="t") == [("a", 400, 2.0), ("unknown", 390, 5.0)]
    assert out(at=at(399), topic="t") == [("old", 100, 4.0), ("unknown", 390, 5.0)]  # a's first sample is too old, its next to come
    assert [r[0] for r in out()] == ["a", "old", "unknown"]
