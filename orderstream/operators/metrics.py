"""Time-series operators over a metric-samples table
(``metric, topic, instance, ts, value``; one sample per series per scrape).

A series is worked on in blocks of time (``BLOCK_S``), so that a long one is spread over
tasks: windows are partitioned by series and block. Where a result depends on samples
before or after it, a block also gets copies of the neighbours' samples as far as
that reaches (the look-back, the range), a few per cent of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderstream.functions.scalar import label_default

SERIES = ("metric", "topic", "instance")
#: Seconds of a series that one window partition holds.
BLOCK_S = 6 * 3600
BLOCK = "_block"


def _ms(c="ts") -> Column:
    return F.unix_millis(F.col(c).cast("timestamp"))


def _ts_lit(t) -> Column:
    return t if hasattr(t, "_jc") else F.lit(t).cast("timestamp")


def floor_div(a: Column, b: int) -> Column:
    """Exact integer floor division (also for negative ``a``)."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("bigint")


def select_series(samples: DataFrame, metric: str | None = None, **labels) -> DataFrame:
    """Label selector: ``metric`` plus exact label matches.  ``topic=None`` picks
    the all-topic aggregate series (label absent)."""
    out = samples
    if metric is not None:
        out = out.where(F.col("metric") == metric)
    for k, v in labels.items():
        out = out.where(F.col(k).isNull() if v is None else (F.col(k) == v))
    return out


def in_blocks(samples: DataFrame, block_s: int, before_s: int = 0, after_s: int = 0) -> DataFrame:
    """The samples with ``ms`` and the block that they work in, ``_block``; each goes to its own block (``_own``) and, as
    a neighbour, to every block that begins up to ``before_s`` after it or ends up to ``after_s`` before it."""
    size, ms = block_s * 1000, _ms("ts")
    s = samples.withColumn("ms", ms)
    home = floor_div(F.col("ms"), size)
    blocks = F.sequence(floor_div(F.col("ms") - after_s * 1000, size), floor_div(F.col("ms") + before_s * 1000, size))
    return s.withColumn(BLOCK, F.explode(blocks)).withColumn("_own", F.col(BLOCK) == home)


def instant(samples: DataFrame, at, lookback_s: int = 300, series: Sequence[str] = SERIES) -> DataFrame:
    """Latest sample of every series at time ``at`` (stale after ``lookback_s``)."""
    t = _ts_lit(at)
    # plain timestamp bounds so both reach a parquet scan as pushed filters
    win = samples.where((F.col("ts") <= t) & (F.col("ts") > t - F.expr(f"INTERVAL {int(lookback_s)} SECONDS")))
    return win.groupBy(*series).agg(
        F.max("ts").alias("ts"),
        F.max_by("value", "ts").alias("value"),
    )


def range_query(samples: DataFrame, start, end, step_s: int = 15, lookback_s: int = 300,
                series: Sequence[str] = SERIES, block_s: int = BLOCK_S) -> DataFrame:
    """Values on the step grid ``start, start+step, ... <= end``: for every step
    the last sample at or before it, if younger than ``lookback_s``.

    Each sample expands to the grid steps it serves (until the next sample or
    the look-back ends), so fan-out per sample is at most lookback/step + 1 and
    there is no grid x series product.
    """
    st, en = _ts_lit(start), _ts_lit(end)
    step, lb = step_s * 1000, lookback_s * 1000
    s = samples.where((F.col("ts") <= en) & (F.col("ts") > st - F.expr(f"INTERVAL {int(lookback_s)} SECONDS")))
    w = Window.partitionBy(*series, BLOCK).orderBy("ms")
    s = in_blocks(s.select(*series, "ts", "value"), block_s, after_s=lookback_s).withColumn("next_ms", F.lead("ms").over(w)).where("_own")
    start_ms, end_ms = F.unix_millis(st), F.unix_millis(en)
    last = F.least(F.coalesce(F.col("next_ms") - 1, F.lit(2**62)), F.col("ms") + lb - 1, end_ms)
    k_lo = F.greatest(-floor_div(start_ms - F.col("ms"), step), F.lit(0).cast("bigint"))
    k_hi = floor_div(last - start_ms, step)
    s = s.select(*series, "value", k_lo.cast("bigint").alias("k_lo"), k_hi.cast("bigint").alias("k_hi"))
    s = s.where(F.col("k_lo") <= F.col("k_hi"))
    out = s.select(*series, "value", F.explode(F.sequence("k_lo", "k_hi")).alias("k"))
    return out.select(*series, F.timestamp_millis(start_ms + F.col("k") * step).alias("ts"), "value")


def sum_by(df: DataFrame, by: Sequence[str] = ("metric", "ts")) -> DataFrame:
    """``sum(...)`` across series, keeping ``by``."""
    return df.groupBy(*by).agg(F.sum("value").alias("value"))


def latest_by_instance(samples: DataFrame, metric: str, at=None, lookback_s: int = 300, series: Sequence[str] = SERIES, **labels) -> DataFrame:
    """Per-broker breakdown at the time ``at``: the value of the newest series of every instance (missing instance ->
    'unknown'); an instance whose samples are all ``lookback_s`` old or older has gone. ``labels`` choose the
    series; of several that remain for an instance the one with the newest sample counts, and of equally new
    ones the first by its labels. The time bounds reach a parquet scan. Without ``at`` every instance's
    newest sample counts, however old."""
    s = select_series(samples, metric, **labels)
    if at is not None:
        s = s.where((F.col("ts") <= _ts_lit(at)) & (F.col("ts") > _ts_lit(at) - F.expr(f"INTERVAL {int(lookback_s)} SECONDS")))
    newest = s.groupBy(*series).agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
    place = F.row_number().over(Window.partitionBy("_of").orderBy(F.desc("ts"), *[F.asc_nulls_first(c) for c in series]))
    best = newest.withColumn("_of", label_default("instance")).withColumn("_place", place).where("_place = 1")
    return best.select(F.col("_of").alias("instance"), "ts", "value")


def counter_deltas(samples: DataFrame, range_s: int, series: Sequence[str] = SERIES, block_s: int = BLOCK_S) -> DataFrame:
    """Reset-aware per-sample counter increase vs the previous sample, in blocks (columns of ``in_blocks``). A
    sample without one, or with none less than ``range_s`` before its block, has 0; after a drop the new value counts from 0."""
    w = Window.partitionBy(*series, BLOCK).orderBy("ms")
    s = in_blocks(samples, block_s, before_s=range_s).withColumn("_prev", F.lag("value").over(w))
    delta = (F.when(F.col("_prev").isNull(), F.lit(0.0))
             .when(F.col("value") < F.col("_prev"), F.col("value"))
             .otherwise(F.col("value") - F.col("_prev")))
    return s.withColumn("delta", delta).drop("_prev")


def window_bound(samples: DataFrame, range_s: int, start, end) -> DataFrame:
    """The samples that windows ending in [start, end] can see; both bounds reach a parquet scan."""
    if end is not None:
        samples = samples.where(F.col("ts") <= _ts_lit(end))
    if start is not None:
        samples = samples.where(F.col("ts") > _ts_lit(start) - F.expr(f"INTERVAL {int(range_s)} SECONDS"))
    return samples


def increase_column(range_s: int, series: Sequence[str] = SERIES) -> Column:
    """Over ``counter_deltas`` rows: counter growth between the samples inside (t - range, t]. The first sample's
    own delta doesn't count, so nothing from before the block's neighbours is needed."""
    w = Window.partitionBy(*series, BLOCK).orderBy("ms").rangeBetween(-(range_s * 1000 - 1), 0)
    return F.sum("delta").over(w) - F.first("delta").over(w)


def increase(samples: DataFrame, range_s: int = 300, series: Sequence[str] = SERIES, start=None, end=None, block_s: int = BLOCK_S) -> DataFrame:
    """``increase(x[range])`` evaluated at every sample (from ``start`` to ``end``): counter
    growth between the samples inside (t - range, t], without extrapolation."""
    d = counter_deltas(window_bound(samples, range_s, start, end), range_s, series, block_s)
    out = d.withColumn("increase", increase_column(range_s, series)).where("_own").drop("delta", "ms", "_own", BLOCK)
    return out if start is None else out.where(F.col("ts") >= _ts_lit(start))


def rate(samples: DataFrame, range_s: int = 300, series: Sequence[str] = SERIES, start=None, end=None, block_s: int = BLOCK_S) -> DataFrame:
    """``rate(x[range])`` = ``increase / range`` per second."""
    inc = increase(samples, range_s, series, start, end, block_s)
    return inc.withColumn("rate", F.col("increase") / F.lit(float(range_s))).drop("increase")


def increase_range(samples: DataFrame, start, end, step_s: int = 15, range_s: int = 300,
                   series: Sequence[str] = SERIES, block_s: int = BLOCK_S) -> DataFrame:
    """``increase(x[range])`` on the step grid ``start, start+step, ... <= end``, for
    series with two samples or more inside (t - range, t].

    A sample's growth since the previous one counts at the steps whose window
    holds both, so each sample expands to range/step steps at most.
    """
    st, en = _ts_lit(start), _ts_lit(end)
    step = step_s * 1000
    w = Window.partitionBy(*series, BLOCK).orderBy("ms")
    d = counter_deltas(window_bound(samples, range_s, start, end), range_s, series, block_s)
    d = d.withColumn("prev_ms", F.lag("ms").over(w)).where(F.col("_own") & F.col("prev_ms").isNotNull())
    start_ms = F.unix_millis(st)
    last = F.least(F.col("prev_ms") + range_s * 1000 - 1, F.unix_millis(en))
    k_lo = F.greatest(-floor_div(start_ms - F.col("ms"), step), F.lit(0).cast("bigint"))
    d = d.select(*series, "delta", k_lo.alias("k_lo"), floor_div(last - start_ms, step).alias("k_hi")).where(F.col("k_lo") <= F.col("k_hi"))
    steps = d.select(*series, "delta", F.explode(F.sequence("k_lo", "k_hi")).alias("k"))
    g = steps.groupBy(*series, "k").agg(F.sum("delta").alias("value"))
    return g.select(*series, F.timestamp_millis(start_ms + F.col("k") * step).alias("ts"), "value")


def rate_range(samples: DataFrame, start, end, step_s: int = 15, range_s: int = 300, series: Sequence[str] = SERIES) -> DataFrame:
    """``rate(x[range])`` on the step grid."""
    inc = increase_range(samples, start, end, step_s, range_s, series)
    return inc.withColumn("value", F.col("value") / F.lit(float(range_s)))


def sum_rate_range(samples: DataFrame, start, end, step_s: int = 15, range_s: int = 300,
                   series: Sequence[str] = SERIES, by: Sequence[str] = ("metric", "ts")) -> DataFrame:
    """``sum(rate(x[range]))`` on the step grid: increases are added up, then divided once."""
    total = sum_by(increase_range(samples, start, end, step_s, range_s, series), by)
    return total.withColumn("value", F.col("value") / F.lit(float(range_s)))
