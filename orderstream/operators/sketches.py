"""Send-log summaries that merge: a quantile sketch for each request and minute, stored as a column.

A summary of any span of time and any set of requests is a merge of the rows it covers, so a dashboard reads
one row for each request and minute instead of the log. The sketches are KLL sketches, built, merged and read
by built-in functions: with ``K`` = 800 an estimate's rank is within ``RANK_ERROR`` of the rank asked for (0.4 % is the sketch's own
bound at 99 % confidence, and merging doesn't add to it). Everything else in a row is a sum or an extreme.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.operators.loadtest import QUANTILES

K = 800
RANK_ERROR = 0.01


def minute_sketches(log: DataFrame, by: Sequence[str] = ("request",), k: int = K) -> DataFrame:
    """``by, minute, sends, errors, messages, first_ms, last_ms, durations``: the mergeable rows. ``durations`` is the sketch of
    the successful sends' durations (null without any); one pass, combined before the shuffle."""
    ok, ms = ~F.col("error"), F.unix_millis("ts")
    return log.groupBy(*by, F.date_trunc("minute", "ts").alias("minute")).agg(
        F.count(F.lit(1)).alias("sends"), F.count_if("error").alias("errors"), F.sum(F.when(ok, F.col("batch_size"))).cast("long").alias("messages"),
        F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms"),
        F.when(F.count_if(ok) > 0, F.kll_sketch_agg_double(F.when(ok, F.col("duration_ms")), k)).alias("durations"))


def merged(rows: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """Rows of ``minute_sketches`` (some, or all) merged by ``by``: the same columns without ``minute``."""
    return rows.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("sends", "errors", "messages")], F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"),
        F.when(F.count("durations") > 0, F.kll_merge_agg_double("durations", k)).alias("durations"))


def quantile(sketch: str, rank: float):
    return F.when(F.col(sketch).isNotNull(), F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def span_percentiles(rows: DataFrame, by: Sequence[str] = ("request",), since=None, until=None, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Estimated percentiles (``p50_ms`` ...) and counts of the minutes in [since, until) by ``by``."""
    if since is not None:
        rows = rows.where(F.col("minute") >= F.lit(since).cast("timestamp"))
    if until is not None:
        rows = rows.where(F.col("minute") < F.lit(until).cast("timestamp"))
    return merged(rows, by).select(*by, "sends", "errors", *[quantile("durations", q).alias(f"p{round(100 * q)}_ms") for q in quantiles])


def span_summary(rows: DataFrame) -> DataFrame:
    """The columns of ``loadtest.load_summary`` from mergeable rows: its percentiles are estimates, the rest is exact."""
    x = merged(rows)
    seconds = (F.col("last_ms") - F.col("first_ms")) / 1000.0
    messages = F.coalesce("messages", F.lit(0).cast("long"))
    return x.select(messages.alias("total_messages"), seconds.alias("duration_s"), F.when(seconds > 0, F.round(messages / seconds)).cast("long").alias("throughput"),
                    *[quantile("durations", q).alias(f"p{round(100 * q)}_ms") for q in QUANTILES],
                    F.when(F.col("sends") > 0, F.col("errors") * 100.0 / F.col("sends")).alias("error_rate_pct"))
