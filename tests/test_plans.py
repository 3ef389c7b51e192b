"""Plan-shape guards over every registered batch query."""

import pytest

from conftest import SF001

from orderstream.plans.catalog import QUERIES

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "PythonUDF")
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_batch_plans(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PY_NODES), name
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_keyed_table_compaction_reopens(spark, tmp_dir):
    from pyspark.sql import functions as F

    from orderstream.plans.catalog import order_stats
    from orderstream.sources.tables import KeyedTable

    path = f"{tmp_dir}/log"
    t = KeyedTable(path)
    stats = order_stats(spark, SF001)
    t.write_batch(stats.where(F.col("order_count") > 1), 0)
    t.write_batch(stats, 1)
    t.compact(spark)
    again = KeyedTable(path)
    assert again.log(spark).count() == again.read(spark).count() == stats.count()
    assert again.read(spark).exceptAll(stats).count() == 0
    assert again.read(spark).where("order_count IS NULL").count() == 0
    # a replay of the last batch and a later one win over the compacted state
    changed = stats.withColumn("order_count", F.col("order_count") + 5)
    again.write_batch(changed.where("user_id < 'user-5'"), 1)
    again.write_batch(stats.where("user_id < 'user-3'"), 2)
    want = stats.where("user_id < 'user-3'").unionByName(changed.where("user_id >= 'user-3' AND user_id < 'user-5'")) \
        .unionByName(stats.where("user_id >= 'user-5'"))
    assert again.read(spark).exceptAll(want).count() == 0 and again.read(spark).count() == stats.count()
    again.drop_old(spark)
    assert KeyedTable(path).read(spark).count() == stats.count()


def test_dashboards_read_the_dates_they_need(spark, tmp_dir):
    import datetime as dt

    from pyspark.sql import functions as F

    from orderstream.operators.analytics import revenue_over_time
    from orderstream.sources.tables import KeyedTable

    t = KeyedTable(f"{tmp_dir}/days")
    rows = spark.range(0, 40 * 24).select(
        F.concat(F.lit("u"), (F.col("id") % 3).cast("string")).alias("user_id"), F.lit(1).cast("long").alias("order_count"),
        F.lit(2.5).alias("total_amount"), F.timestamp_seconds(F.col("id") * 3600).alias("window_start"),
        F.timestamp_seconds(F.col("id") * 3600 + 60).alias("window_end"))
    t.write_batch(rows, 0)
    part = t.latest(spark, 60)
    assert part.count() == 3 * 24  # three of forty days hold the latest 60 windows
    assert "PartitionFilters" in _plan(part) and "1970-02-07" in _plan(part)
    got = [r[0] for r in revenue_over_time(part, 60).collect()]
    assert len(got) == 60 and got[-1] == dt.datetime(1970, 2, 9, 23) and got == sorted(got)
    assert t.latest(spark, 10 ** 6).count() == 40 * 24


def test_aggregates_without_sorts(spark):
    plan = QUERIES["upsert_latest"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    plan = QUERIES["kpi_global"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2
    for name in ("load_summary", "slo_check", "latency_percentiles"):
        assert "percentile(" not in QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    plan = QUERIES["metric_names_parsed"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") <= 2 and "RLIKE" not in plan


def test_alert_states_scan_once(spark, tmp_dir):
    """The carried starts of islands come from the same shuffled samples: one scan, however many blocks there are."""
    from orderstream.operators.alerts import alert_timeline
    from orderstream.plans.fixtures import metric_samples

    metric_samples(spark, SF001).write.parquet(f"{tmp_dir}/samples")
    timeline = alert_timeline(spark.read.parquet(f"{tmp_dir}/samples"), block_s=600)
    timeline.collect()
    final = timeline._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 or "ReusedExchange" in final
    assert "_block" in final and "CartesianProduct" not in final


@pytest.mark.parametrize("name", ["metric_range", "metric_increase_5m", "metric_rate_5m", "alert_timeline"])
def test_series_are_worked_on_in_blocks(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    windows = [w for w in plan.splitlines() if " Window " in w and "instance" in w]
    exchanges = [w for w in plan.splitlines() if "Exchange hashpartitioning" in w and "instance" in w]
    assert windows and exchanges and any("_block" in e for e in exchanges)


def test_dashboards_follow_a_table_rewritten_at_its_path(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    here = str(tmp_path / "here")
    events.where("event_id % 2 = 0").write.parquet(f"{here}/events.parquet")
    first = QUERIES["kpi_global"](spark, here).collect()
    assert QUERIES["kpi_global"](spark, here).collect() == first
    events.write.mode("overwrite").parquet(f"{here}/events.parquet")
    there = str(tmp_path / "there")
    events.write.parquet(f"{there}/events.parquet")
    want = QUERIES["kpi_global"](spark, there).collect()
    assert want != first and QUERIES["kpi_global"](spark, here).collect() == want
