"""Window edges, plan shape, the watermark guard, stream = batch, replay idempotence."""

import json
import os

from pyspark.sql import functions as F

from orderstream.operators.windows import guarded_filter, windowed_stats, with_event_watermark
from orderstream.sources.tables import KeyedTable
from orderstream.streaming.job import dropped_late_rows, order_stats_plan


def _ev(ts, amount, status="PLACED", user="u1", order=None):
    return json.dumps({"order_id": order or f"o{ts}", "user_id": user, "amount": amount,
                       "status": status, "timestamp": ts})


def test_window_edges(spark):
    df = spark.createDataFrame([(t,) for t in (0, 59999, 60000, 119999)], "ms long")
    df = df.select(F.lit("u").alias("user_id"), F.lit(1.0).alias("amount"),
                   F.timestamp_millis("ms").alias("event_time"))
    got = sorted((F_r["window_start"].minute, F_r["order_count"]) for F_r in windowed_stats(df).collect())
    assert got == [(0, 2), (1, 2)]


def test_single_exchange_and_no_python_udf(spark):
    from conftest import SF01
    from orderstream.plans.catalog import q_order_stats_1m

    plan = q_order_stats_1m(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "partial_count" in plan


def _optimized(df):
    s = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    return s.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_guard_stays_above_watermark(spark, tmp_dir):
    raw = spark.readStream.schema("status string, amount double, event_time timestamp").json(tmp_dir)
    wm = with_event_watermark(raw)
    pred = F.col("status").eqNullSafe("PLACED") & F.coalesce(F.col("amount") >= 0, F.lit(True))
    plain = [l for l in _optimized(wm.where(pred)).split("\n") if "Filter" in l or "EventTimeWatermark" in l]
    guard = [l for l in _optimized(guarded_filter(wm, pred)).split("\n") if "Filter" in l or "EventTimeWatermark" in l]
    assert "EventTimeWatermark" in plain[0]          # plain filter is pushed below
    assert "Filter" in guard[0] and "EventTimeWatermark" in guard[1]


def _run(spark, root, batches, guard):
    src = os.path.join(root, f"src-{guard}")
    os.makedirs(src)
    table = KeyedTable(os.path.join(root, f"out-{guard}"))
    plan = order_stats_plan(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src), guard=guard)
    q = (plan.writeStream.outputMode("append").foreachBatch(table.write_batch)
         .option("checkpointLocation", os.path.join(root, f"ck-{guard}")).start())
    seen = []
    try:
        for i, b in enumerate(batches):
            with open(os.path.join(src, f"{i:03d}.json"), "w") as f:
                f.write("\n".join(b) + "\n")
            q.processAllAvailable()
            emitted = set()
            if os.path.exists(table.path):
                emitted = {r[0] for r in table.log(spark).select("user_id").collect()}
            seen.append(emitted)
        return table, dropped_late_rows(q), seen
    finally:
        q.stop()


WATERMARK_EDGES = [
    [_ev(1000, 5.0), _ev(59999, 7.0)],
    [_ev(64999, 100.0, status="SHIPPED")],
    [_ev(65000, -1.0)],                 # poison but still advances event time
    [_ev(66000, 3.0, user="u2")],
    [_ev(2000, 100.0)],                 # late for the closed window
    [_ev(10**12, 1.0, user="sentinel")],
    [_ev(10**12, 1.0, user="sentinel", order="s2")],
]


def test_watermark_edges_with_guard(spark, tmp_dir):
    table, dropped, seen = _run(spark, tmp_dir, WATERMARK_EDGES, guard=True)
    # window [0, 60000) of u1 closes once the poison event (file 2) moved the watermark to 60000
    assert "u1" not in seen[1] and "u1" in seen[2]
    assert dropped >= 1
    cur = {r["user_id"]: (r["order_count"], r["total_amount"]) for r in table.read(spark).collect()}
    assert cur == {"u1": (2, 12.0), "u2": (1, 3.0)}


def test_without_guard_window_closes_later(spark, tmp_dir):
    table, _, seen = _run(spark, tmp_dir, WATERMARK_EDGES, guard=False)
    # filtered-out rows no longer advance time: the window only closes after file 3
    assert "u1" not in seen[2] and "u1" in seen[3]


def test_keyed_table_replay_is_idempotent(spark, tmp_dir):
    t = KeyedTable(os.path.join(tmp_dir, "t"))
    df = spark.createDataFrame(
        [("u", 1, 5.0, "2024-01-01 00:00:00", "2024-01-01 00:01:00")],
        "user_id string, order_count long, total_amount double, window_start string, window_end string",
    ).select("user_id", "order_count", "total_amount", F.col("window_start").cast("timestamp").alias("window_start"),
             F.col("window_end").cast("timestamp").alias("window_end"))
    t.write_batch(df, 0)
    first = sorted(tuple(r) for r in t.read(spark).collect())
    t.write_batch(df, 0)                              # replay of the same batch
    assert sorted(tuple(r) for r in t.read(spark).collect()) == first
    later = df.withColumn("order_count", F.lit(3).cast("bigint")).withColumn(
        "window_end", F.col("window_end") + F.expr("INTERVAL 1 HOUR"))
    t.write_batch(later, 1)                           # upsert: counts update, window_end stays
    row = t.read(spark).first()
    assert row["order_count"] == 3 and row["window_end"] == first[0][4]
