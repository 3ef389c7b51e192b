"""Alert rules with hold time, evaluated over metric samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderstream.functions.scalar import severity_default
from orderstream.operators.metrics import BLOCK, BLOCK_S, SERIES, counter_deltas, increase_column, window_bound


@dataclass(frozen=True)
class AlertRule:
    alert: str
    metric: str
    op: str                 # '>' or '=='
    threshold: float
    for_s: int
    severity: str
    summary: str
    func: str = "value"     # value | rate | increase
    range_s: int | None = None
    topic: str | None = None


# The shipped rule set (nine distinct alerts).  The two DLQ rules
# apply rate/increase to the message *counter* (the gauge they targeted cannot
# be rated meaningfully).
DEFAULT_RULES = [
    AlertRule("KafkaHighProducerLatency", "kafka_network_request_metrics_produce_total_time_ms_p99",
              ">", 10, 120, "warning", "P99 produce latency exceeded 10ms"),
    AlertRule("KafkaUnderReplicatedPartitions", "kafka_server_replica_manager_under_replicated_partitions",
              ">", 0, 60, "critical", "Under-replicated partitions detected"),
    AlertRule("KafkaOfflinePartitions", "kafka_controller_offline_partitions_count",
              ">", 0, 60, "critical", "Offline partitions detected"),
    AlertRule("KafkaNoActiveController", "kafka_controller_active_controller_count",
              "==", 0, 60, "critical", "No active Kafka controller"),
    AlertRule("FlinkCheckpointFailed", "flink_jobmanager_job_numberOfFailedCheckpoints",
              ">", 0, 300, "critical", "Flink checkpoint failures detected", "increase", 300),
    AlertRule("FlinkCheckpointDurationHigh", "flink_jobmanager_job_lastCheckpointDuration",
              ">", 60000, 300, "warning", "Flink checkpoint duration exceeded 60s"),
    AlertRule("FlinkJobNotRunning", "flink_jobmanager_job_uptime",
              "==", 0, 120, "critical", "Flink job is not running"),
    AlertRule("DLQEventsDetected", "kafka_server_broker_topic_metrics_messages_in_total",
              ">", 0, 300, "warning", "Events detected in DLQ topic", "increase", 300, "order-events-dlq"),
    AlertRule("DLQHighRate", "kafka_server_broker_topic_metrics_messages_in_total",
              ">", 10, 120, "critical", "High DLQ event rate (>10/sec)", "rate", 300, "order-events-dlq"),
]

RULE_SCHEMA = ("alert string, metric string, op string, threshold double, for_s int, severity string, "
               "summary string, func string, range_s int, topic string")


def rules_frame(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame(
        [(r.alert, r.metric, r.op, float(r.threshold), r.for_s, r.severity, r.summary, r.func, r.range_s, r.topic)
         for r in rules], RULE_SCHEMA)


def _rule_inputs(samples: DataFrame, rules, series: Sequence[str], before_s: int, block_s: int) -> DataFrame:
    """Every sample of a metric that a rule names, in blocks of time with its neighbours of ``before_s``, and its
    counter increase over each range the rules use: one pass over the series, rate and increase of a
    range share their deltas."""
    s = samples.where(F.col("metric").isin(sorted({r.metric for r in rules})))
    d = counter_deltas(s, before_s, series, block_s)
    ranges = sorted({r.range_s for r in rules if r.func != "value"})
    return d.select(*series, BLOCK, "_own", "ts", "ms", "value", *[increase_column(r, series).alias(f"inc_{r}") for r in ranges])


def _expression(rules) -> Column:
    """A rule's value at a sample, from the columns of ``_rule_inputs`` and the rule."""
    out = F.when(F.col("func") == "value", F.col("value"))
    for r in sorted({r.range_s for r in rules if r.func != "value"}):
        inc = F.col(f"inc_{r}")
        out = out.when((F.col("func") == "increase") & (F.col("range_s") == r), inc)
        out = out.when((F.col("func") == "rate") & (F.col("range_s") == r), inc / F.lit(float(r)))
    return out


def alert_timeline(samples: DataFrame, rules=DEFAULT_RULES, staleness_s: int = 300, series: Sequence[str] = SERIES,
                   since=None, at=None, block_s: int = BLOCK_S) -> DataFrame:
    """State of every (rule, series) at every sample in [since, at].

    A sample where the condition holds starts or continues an *island*; a false
    sample, or a gap longer than ``staleness_s`` since the previous sample,
    ends it.  ``active_at`` = first sample of the island (in the time asked for);
    ``firing`` once ``ts - active_at >= for``, ``pending`` before, ``inactive``
    when false.  ``series`` names the label columns that tell series apart; it
    has to include ``metric``, and ``topic`` if a rule selects by it.

    Series are worked on in blocks of time. Where an island starts is decided inside a block with
    its neighbours; the start of one that goes on from an earlier block comes through a table
    of the blocks' last starts.
    """
    unknown = {r.func for r in rules} - {"value", "rate", "increase"}
    if unknown:
        raise ValueError(f"unknown rule function {sorted(unknown)}")
    # the rule list is a local table: Spark sees its size and picks the join
    rf = rules_frame(samples.sparkSession, rules).withColumnsRenamed({"metric": "rule_metric", "topic": "rule_topic"})
    longest = max([r.range_s or 0 for r in rules], default=0)
    x = _rule_inputs(window_bound(samples, longest, since, at), rules, series, longest + staleness_s + 1, block_s)
    if since is not None:
        x = x.where(F.col("ts") >= F.lit(since).cast("timestamp"))
    on = F.col("metric") == F.col("rule_metric")
    if "topic" in series:
        on = on & (F.col("rule_topic").isNull() | (F.col("topic") == F.col("rule_topic")))
    j = x.join(rf, on).withColumn("expr_value", _expression(rules))
    cond = (F.when(F.col("op") == ">", F.col("expr_value") > F.col("threshold"))
            .when(F.col("op") == "==", F.col("expr_value") == F.col("threshold"))
            .otherwise(F.lit(False)))
    key = ["alert", *series]
    w = Window.partitionBy(*key, BLOCK).orderBy("ms")
    j = j.withColumn("cond", F.coalesce(cond, F.lit(False)))
    prev_cond = F.lag("cond").over(w)
    gap = F.col("ms") - F.lag("ms").over(w)
    start = F.col("cond") & (prev_cond.isNull() | ~prev_cond | (gap > staleness_s * 1000))
    j = j.withColumn("start", F.when(start, F.col("ts"))).where("_own")
    j = j.withColumn("here", F.max("start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # a block whose first sample continues an island: the newest start of the blocks before it
    blocks = j.groupBy(*key, BLOCK).agg(F.max("start").alias("last"))
    earlier = Window.partitionBy(*key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.withColumn("carried", F.max("last").over(earlier)).where("carried IS NOT NULL")
    carried = carried.select(*[F.col(c).alias(f"_{c}") for c in key], F.col(BLOCK).alias("_of"), "carried")
    same = F.col(BLOCK) == F.col("_of")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    j = j.join(carried, same, "left").withColumn("island", F.coalesce("here", "carried"))
    state = (F.when(~F.col("cond"), F.lit("inactive"))
             .when(F.col("ms") - F.unix_millis("island") >= F.col("for_s") * 1000, F.lit("firing"))
             .otherwise(F.lit("pending")))
    return j.select(
        *key, "ts", F.col("expr_value").alias("value"), state.alias("state"),
        F.when(F.col("cond"), F.timestamp_millis(F.unix_millis("island"))).alias("active_at"),
        severity_default("severity", state).alias("severity"), "summary",
    )


def alert_states(samples: DataFrame, rules=DEFAULT_RULES, staleness_s: int = 300, series: Sequence[str] = SERIES,
                 since=None, at=None) -> DataFrame:
    """State per (rule, series) at the time ``at``: that of its newest sample up to
    then.  A series whose newest sample is ``staleness_s`` old or older has gone, and its
    alerts with it.  Without ``at`` every series is judged at its own newest sample."""
    t = alert_timeline(samples, rules, staleness_s, series, since, at)
    latest = t.groupBy("alert", *series).agg(
        F.max_by(F.struct("ts", "value", "state", "active_at", "severity", "summary"), "ts").alias("s"))
    out = latest.select("alert", *series, "s.*")
    if at is not None:
        out = out.where(F.col("ts") > F.lit(at).cast("timestamp") - F.expr(f"INTERVAL {int(staleness_s)} SECONDS"))
    return out


def state_counts(states: DataFrame) -> DataFrame:
    """Alert counts by state (firing / pending / inactive)."""
    return states.agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("firing", "pending", "inactive")])


def by_state(states: DataFrame, *wanted: str) -> DataFrame:
    return states.where(F.col("state").isin(list(wanted)))


def by_name(states: DataFrame, *names: str) -> DataFrame:
    return states.where(F.col("alert").isin(list(names)))
