"""Send-log summaries: throughput, latency percentiles, error rate, SLO checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.functions.scalar import money_sum
from orderstream.operators.percentiles import exact_percentiles

# Load profiles and their pass/fail limits
# (error rate in percent, p99 send latency in ms).
PROFILES = [
    ("low", 1.0, 50.0),
    ("default", 1.0, 10.0),
    ("high", 1.0, 10.0),
    ("stress", 5.0, 25.0),
]
QUANTILES = (0.5, 0.95, 0.99)


def load_summary(log: DataFrame, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """One row: messages sent, run duration, throughput (rounded events/s),
    p50/p95/p99 of successful send durations, error rate in percent.  The exact
    percentiles split over tasks; ``exact=False`` uses a bounded-memory sketch."""
    ok = ~F.col("error")
    sent = F.when(ok, F.col("duration_ms"))
    aggs = [
        F.sum(F.when(ok, F.col("batch_size"))).cast("bigint").alias("total_messages"),
        ((F.max(F.unix_millis("ts")) - F.min(F.unix_millis("ts"))) / 1000.0).alias("duration_s"),
        (F.count_if(F.col("error")) * 100.0 / F.count(F.lit(1))).alias("error_rate_pct"),
    ]
    if exact:
        parts = log.agg(*aggs).unionByName(
            exact_percentiles(log.where(ok), "duration_ms", [], QUANTILES).select("p0", "p1", "p2"), allowMissingColumns=True)
        agg = parts.agg(*[F.max(c).alias(c) for c in parts.columns])  # the two rows as one
    else:
        agg = log.agg(*aggs, F.percentile_approx(sent, list(QUANTILES), accuracy).alias("q")).select(
            "*", *[F.col("q")[i].alias(f"p{i}") for i in range(3)])
    return agg.select(
        F.coalesce("total_messages", F.lit(0).cast("bigint")).alias("total_messages"),
        "duration_s",
        F.when(F.col("duration_s") > 0, F.round(F.col("total_messages") / F.col("duration_s")))
        .cast("bigint").alias("throughput"),
        F.col("p0").alias("p50_ms"), F.col("p1").alias("p95_ms"), F.col("p2").alias("p99_ms"),
        "error_rate_pct",
    )


def latency_percentiles(log: DataFrame, by=("request",), window: str | None = "5 minutes",
                        exact: bool = True, accuracy: int = 10000, exact_money: bool = False) -> DataFrame:
    """p50/p95/p99/mean of send duration per request type and time window."""
    keys = list(by)
    if window:
        log = log.withColumn("window_start", F.window("ts", window)["start"].cast("timestamp_ntz"))
        keys.append("window_start")
    mean = money_sum("duration_ms", exact_money) / F.count(F.lit(1))
    aggs = [mean.alias("mean_ms"), F.count(F.lit(1)).alias("samples")]
    if not exact:
        g = log.groupBy(*keys).agg(F.percentile_approx("duration_ms", list(QUANTILES), accuracy).alias("q"), *aggs)
        return g.select(*keys, *[F.col("q")[i].alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))], "mean_ms", "samples")
    p = exact_percentiles(log, "duration_ms", keys, QUANTILES).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("p0").alias("p50_ms"), F.col("p1").alias("p95_ms"), F.col("p2").alias("p99_ms"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return (log.groupBy(*keys).agg(*aggs).join(p, same, "left")
            .select(*keys, "p50_ms", "p95_ms", "p99_ms", "mean_ms", "samples"))


def slo_check(summary: DataFrame, profiles=PROFILES) -> DataFrame:
    """Pass/fail of a load summary against every profile's limits.  The profile
    list is attached by ``explode`` of a literal array (no join)."""
    arr = F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(e).alias("max_error_rate_pct"),
                             F.lit(l).alias("max_p99_ms")) for p, e, l in profiles])
    x = summary.select("*", F.explode(arr).alias("p")).select("*", "p.*").drop("p")
    return x.select(
        "profile", "max_error_rate_pct", "max_p99_ms", "error_rate_pct", "p99_ms",
        (F.col("error_rate_pct") < F.col("max_error_rate_pct")).alias("error_ok"),
        (F.col("p99_ms") < F.col("max_p99_ms")).alias("p99_ok"),
    ).withColumn("passed", F.col("error_ok") & F.col("p99_ok"))
