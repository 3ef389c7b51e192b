"""Small scalar helpers: backoff, banding, guarded ratios, time conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


MAX_LONG = 2 ** 63 - 1
MAX_EPOCH_MS = 253402300799999  # 9999-12-31 23:59:59.999


def backoff_ms(retry_count="retry_count", base_ms: int = 1000) -> Column:
    """Exponential backoff ``base * 2^n`` in integer milliseconds.  A negative
    count backs off like 0; a product beyond 64 bits stays at the largest long."""
    n = F.greatest(_col(retry_count), F.lit(0))
    top = (MAX_LONG // base_ms).bit_length() - 1  # the largest n whose product fits
    shift = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.least(n, F.lit(top)).cast("int"))
    return F.when(n > top, F.lit(MAX_LONG)).otherwise(F.lit(base_ms).cast("bigint") * shift)


def after_ms(clock, delay_ms) -> Column:
    """``clock`` plus a delay, at most the end of the year 9999."""
    now, delay = F.unix_millis(_col(clock)), _col(delay_ms)
    late = delay > F.lit(MAX_EPOCH_MS) - now
    return F.timestamp_millis(F.when(late, F.lit(MAX_EPOCH_MS)).otherwise(now + F.when(~late, delay)))


def safe_ratio(num, den, default=0.0) -> Column:
    """``num / den`` when ``den > 0`` else ``default`` (ANSI mode raises on /0)."""
    d = _col(den)
    return F.when(d > 0, _col(num).cast("double") / d.cast("double")).otherwise(F.lit(default).cast("double"))


def band(value, critical: float, warning: float, *, labels=("critical", "warning", "ok"),
         higher_is_worse: bool = True) -> Column:
    """Three-level threshold banding (``>= critical`` / ``>= warning`` / rest)."""
    v = _col(value)
    if higher_is_worse:
        return (F.when(v >= critical, labels[0]).when(v >= warning, labels[1]).otherwise(labels[2]))
    return (F.when(v <= critical, labels[0]).when(v <= warning, labels[1]).otherwise(labels[2]))


def severity_default(severity="severity", state="state") -> Column:
    """Given severity, else firing -> warning, anything else -> info."""
    return F.coalesce(_col(severity), F.when(_col(state) == "firing", "warning").otherwise("info"))


def label_default(label, default: str = "unknown") -> Column:
    """Missing or empty label -> ``default``."""
    return F.coalesce(F.nullif(_col(label), F.lit("")), F.lit(default))


def money_sum(c, exact: bool = False) -> Column:
    """Sum of a money column: a double sum, in batch and stream alike, which keeps
    NaN, fractions of a cent and amounts of any size.  ``exact`` is for inputs known
    to be two-decimal amounts below 10^16: it sums them as decimal(18,2), so the
    result does not depend on row order, and fails on an amount that does not fit."""
    if exact:
        return F.sum(_col(c).cast("decimal(18,2)")).cast("double")
    return F.sum(_col(c))


def to_epoch_ms(ts) -> Column:
    return F.unix_millis(_col(ts).cast("timestamp"))


def from_epoch_ms(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def naive(ts) -> Column:
    """Session-zone timestamp -> zone-less timestamp (outer edge of oracle-compared output)."""
    return _col(ts).cast("timestamp_ntz")


def sample_value(v) -> Column:
    """Metric sample value transported as text -> double (``NaN``/``+Inf`` allowed)."""
    return _col(v).try_cast("double")


def from_epoch_s(s) -> Column:
    """Epoch seconds (possibly fractional) -> timestamp."""
    return F.timestamp_micros((_col(s).cast("double") * 1_000_000).cast("bigint"))
