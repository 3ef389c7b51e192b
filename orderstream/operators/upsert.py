"""Keyed materialisation: last-write-wins upsert and duplicate suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstream.schema import STATS_KEYS, STATS_UPDATE_COLS


def upsert_latest(log: DataFrame, keys: Sequence[str] = STATS_KEYS,
                  update_cols: Sequence[str] = STATS_UPDATE_COLS, order_col: str = "batch_id") -> DataFrame:
    """Materialise an append-only change log as an upserted table.

    Per key, ``update_cols`` come from the latest write (highest ``order_col``);
    every other column keeps the value of the first write, exactly like
    ``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.  A key has one
    row in a batch.  One ``max_by``/``min_by`` per column: over fixed-width columns
    that is a hash aggregate, combined before the shuffle and without a sort
    (a string column makes Spark sort instead).
    """
    keep_first = [c for c in log.columns if c not in keys and c not in update_cols and c != order_col]
    o = F.col(order_col)
    aggs = [F.max_by(F.col(c), o).alias(c) for c in update_cols] + [F.min_by(F.col(c), o).alias(c) for c in keep_first]
    return log.groupBy(*keys).agg(*aggs).select(*[c for c in log.columns if c != order_col])


def dedup_first(df: DataFrame, key: str = "order_id", order: Sequence[str] = ("timestamp", "event_id")) -> DataFrame:
    """Keep one row per ``key``: the first by ``order`` (deterministic).

    A ranked window of which only rank 1 is asked for: Spark limits every key to
    its first row in each map task already, so a key that holds a large share of
    all rows reaches its reducer as one row a task.
    """
    order = [c for c in order if c in df.columns]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def dedup_streaming(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Streaming duplicate suppression bounded by the watermark (state expires)."""
    return df.dropDuplicatesWithinWatermark([key])
