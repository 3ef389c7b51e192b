"""Event-time windows: watermark-safe filtering and the per-key tumbling aggregate."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.functions.scalar import money_sum

_MIN_TS = "0001-01-01 00:00:00"
_MAX_TS = "9999-12-31 00:00:00"


def guarded_filter(df: DataFrame, predicate: Column, event_time: str = "event_time") -> DataFrame:
    """Filter that stays *above* an upstream watermark.

    Catalyst pushes ordinary predicates that do not reference the event-time
    column below ``EventTimeWatermark``; rows that fail them would then no
    longer advance event time, which changes when windows close.  Folding the
    predicate into a comparison on the event-time column keeps it above the
    watermark node.  ``predicate`` must be null-safe.
    """
    bound = F.when(predicate, F.lit(_MIN_TS).cast("timestamp")).otherwise(F.lit(_MAX_TS).cast("timestamp"))
    return df.where(F.col(event_time) >= bound)


def with_event_watermark(df: DataFrame, event_time: str = "event_time", delay: str = "5 seconds") -> DataFrame:
    """Bounded out-of-orderness watermark (event time must be a session-zone timestamp)."""
    return df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)


def watermark_by_split(splits: Sequence[DataFrame], event_time: str = "event_time", delay: str = "5 seconds") -> DataFrame:
    """One stream of several splits (topic partitions), each with a watermark of its own.

    Over a union Spark goes by the smallest of the watermarks (its default policy, ``spark.sql.streaming.multipleWatermarkPolicy`` = min),
    so a split that lags behind the others loses no rows; a row is late if it lies behind its
    slowest split. A split without any rows yet holds all windows open.
    """
    return functools.reduce(DataFrame.unionByName, [with_event_watermark(s, event_time, delay) for s in splits])


def windowed_stats(df: DataFrame, key: str = "user_id", event_time: str = "event_time",
                   width: str = "1 minute", amount: str = "amount", exact: bool = False,
                   extra_aggs: list[Column] | None = None) -> DataFrame:
    """Per-key tumbling-window count and amount sum.

    Output ``key, order_count, total_amount, window_start, window_end``.
    One hash exchange on (key, window) with map-side partial aggregation, so a
    hot key is pre-combined on every map task before the shuffle.
    """
    aggs = [F.count(F.lit(1)).alias("order_count"), money_sum(amount, exact).alias("total_amount")]
    aggs += list(extra_aggs or [])
    g = df.groupBy(F.col(key), F.window(F.col(event_time), width).alias("window")).agg(*aggs)
    extra_names = [c for c in g.columns if c not in (key, "window", "order_count", "total_amount")]
    return g.select(
        F.col(key), "order_count", "total_amount",
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *extra_names,
    )
