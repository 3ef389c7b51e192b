"""Dashboard queries over the keyed result table (``user_order_stats`` shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.functions.scalar import money_sum, safe_ratio
from orderstream.schema import MALFORMED_JSON, MISSING_ORDER_ID, MISSING_USER_ID, NEGATIVE_AMOUNT


def top_users(stats: DataFrame, n: int = 20, key: str = "user_id", exact: bool = False) -> DataFrame:
    """Users by total revenue, descending; ties broken by key.  The limit is the
    feature (a top-k report): Spark plans it as a per-partition top-k followed
    by one small merge, never a global sort."""
    agg = stats.groupBy(key).agg(
        F.sum("order_count").cast("bigint").alias("order_count"),
        money_sum("total_amount", exact).alias("total_amount"),
    )
    return agg.orderBy(F.col("total_amount").desc(), F.col(key).asc()).limit(n)


def _latest_windows(stats: DataFrame, measure: str, n: int, exact: bool = False) -> DataFrame:
    if measure == "total_amount":
        m = money_sum("total_amount", exact).alias("total_amount")
    else:
        m = F.sum(measure).cast("bigint").alias(measure)
    latest = stats.groupBy("window_start").agg(m).orderBy(F.col("window_start").desc()).limit(n)
    return latest.orderBy("window_start")


def revenue_over_time(stats: DataFrame, n: int = 60, exact: bool = False) -> DataFrame:
    """Revenue of the latest ``n`` windows, shown oldest first."""
    return _latest_windows(stats, "total_amount", n, exact)


def volume_over_time(stats: DataFrame, n: int = 60) -> DataFrame:
    """Order count of the latest ``n`` windows, shown oldest first."""
    return _latest_windows(stats, "order_count", n)


def kpis(stats: DataFrame, exact: bool = False) -> DataFrame:
    """Revenue, orders and average order value (one row).  Over ``top_users`` this
    is the dashboard's top-N KPI; over the result table itself it is the global
    KPI, one aggregate without a grouping by user."""
    agg = stats.agg(
        money_sum("total_amount", exact).alias("revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).cast("bigint").alias("orders"),
    )
    return agg.select(
        F.coalesce(F.col("revenue"), F.lit(0.0)).alias("revenue"),
        "orders",
        safe_ratio(F.coalesce(F.col("revenue"), F.lit(0.0)), "orders").alias("avg_order_value"),
    )


def user_totals(stats: DataFrame, key: str = "user_id", exact: bool = False) -> DataFrame:
    return stats.groupBy(key).agg(
        F.sum("order_count").cast("bigint").alias("order_count"),
        money_sum("total_amount", exact).alias("total_amount"),
    )


_REASONS = (NEGATIVE_AMOUNT, MISSING_USER_ID, MISSING_ORDER_ID, MALFORMED_JSON)


def dlq_accounting(tagged: DataFrame, by: list | None = None) -> DataFrame:
    """Dead-letter accounting over tagged events: totals, share and a count per
    reason, globally or per group (e.g. a time window).  One aggregate pass."""
    r = F.col("dlq_reason")
    aggs = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(r.isNull()).alias("valid"),
        F.count_if(r.isNotNull()).alias("dlq"),
    ] + [F.count_if(r == F.lit(x)).alias(x.lower()) for x in _REASONS]
    g = tagged.groupBy(*by).agg(*aggs) if by else tagged.agg(*aggs)
    return g.withColumn("dlq_share", safe_ratio("dlq", "total"))
