"""Alert rules on a stream of metric samples: the hold-time state of every (rule, series) in the state store.

A series' samples wait until the watermark has passed them and are then taken in order of time, so samples may arrive
in any order within the delay; later ones are dropped. For each sample and rule that selects the series there is a row, as in
``operators.alerts.alert_timeline``: the state keeps when a condition began to hold, however long ago that was.
A series without a sample for ``staleness_s`` has gone: its timeout forgets it, and a row with state ``gone`` ends each
alert that was pending or firing.

The state of a series is its waiting samples, the counter growth of the longest range that a rule uses and one
start time for each rule. Rules are compared in Python, a group of samples of a series at a time; that a
condition's start outlives any window is what built-in aggregates can't express.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orderstream.functions.scalar import severity_default
from orderstream.operators.alerts import DEFAULT_RULES, AlertRule
from orderstream.operators.metrics import SERIES
from orderstream.operators.windows import guarded_filter

GONE = "gone"
_NEVER = -(2 ** 62)
_STATE = ("wait_ms array<bigint>, wait_value array<double>, done_ms bigint, done_value double, grown_ms array<bigint>, grown array<double>, "
          "since array<bigint>")


def _holds(rule: AlertRule, value) -> bool:
    if value is None or value != value:
        return False
    return value > rule.threshold if rule.op == ">" else value == rule.threshold if rule.op == "==" else False


class SeriesState:
    """The rules of one series and what they remember."""

    def __init__(self, rules: Sequence[AlertRule], staleness_ms: int, stored: tuple | None):
        self.rules, self.staleness_ms = rules, staleness_ms
        self.longest = max([(r.range_s or 0) * 1000 for r in rules], default=0)
        wait_ms, wait_value, self.done_ms, self.done_value, grown_ms, grown, since = stored or ([], [], _NEVER, None, [], [], [_NEVER] * len(rules))
        self.waiting = dict(zip(wait_ms, wait_value, strict=True))
        self.grown, self.since = list(zip(grown_ms, grown, strict=True)), list(since)

    def stored(self) -> tuple:
        at = sorted(self.waiting)
        return (at, [self.waiting[t] for t in at], self.done_ms, self.done_value, [t for t, _ in self.grown], [d for _, d in self.grown], self.since)

    def arrive(self, ms: int, value: float | None) -> None:
        if ms > self.done_ms:
            self.waiting[ms] = value

    def _value(self, rule: AlertRule, ms: int, value):
        if rule.func == "value":
            return value
        inside = [d for t, d in self.grown if t > ms - rule.range_s * 1000]
        growth = sum(inside[1:])  # between the samples inside the range
        return growth if rule.func == "increase" else growth / rule.range_s

    def take(self, until_ms: int) -> Iterator[tuple]:
        """(rule, ms, value, state, active since) of the samples up to a time."""
        for ms in sorted(t for t in self.waiting if t <= until_ms):
            value, before = self.waiting.pop(ms), self.done_value
            if self.longest:
                delta = 0.0 if before is None or value is None else value if value < before else value - before
                self.grown = [(t, d) for t, d in self.grown if t > ms - self.longest] + [(ms, delta)]
            gap = ms - self.done_ms > self.staleness_ms
            for i, rule in enumerate(self.rules):
                v = self._value(rule, ms, value)
                if not _holds(rule, v):
                    self.since[i] = _NEVER
                    yield rule, ms, v, "inactive", None
                    continue
                if gap or self.since[i] == _NEVER:
                    self.since[i] = ms
                yield rule, ms, v, "firing" if ms - self.since[i] >= rule.for_s * 1000 else "pending", self.since[i]
            self.done_ms, self.done_value = ms, value

    def gone_at(self) -> int | None:
        """When the series has gone if nothing else comes; None before its first sample was taken."""
        return None if self.done_ms == _NEVER else self.done_ms + self.staleness_ms

    def active(self) -> list[AlertRule]:
        return [r for r, s in zip(self.rules, self.since, strict=True) if s != _NEVER]


def _time(ms):
    return pd.NaT if ms is None else pd.Timestamp(ms, unit="ms")


def alert_stream(samples: DataFrame, rules: Sequence[AlertRule] = DEFAULT_RULES, staleness_s: int = 300, delay: str = "30 seconds") -> DataFrame:
    """``alert, metric, topic, instance, ts, value, state, active_at, severity, summary`` for a stream of samples."""
    rules = list(rules)
    kind = dict(samples.dtypes)
    schema = (f"alert string, {', '.join(f'{c} {kind[c]}' for c in SERIES)}, ts timestamp, value double, state string, active_at timestamp, "
              "severity string, summary string")

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        metric, topic, instance = key
        own = [r for r in rules if r.metric == metric and (r.topic is None or r.topic == topic)]
        if not own:
            return
        s = SeriesState(own, staleness_s * 1000, state.get if state.exists else None)
        for part in parts:
            times = (part["ts"].astype("datetime64[ns]").astype("int64") // 1_000_000).tolist()
            for ms, value in zip(times, part["value"].tolist(), strict=True):
                s.arrive(ms, value)
        now = state.getCurrentWatermarkMs()
        out = [(r.alert, metric, topic, instance, _time(ms), v, st, _time(since), r.severity, r.summary) for r, ms, v, st, since in s.take(now)]
        over = s.gone_at()
        if not s.waiting and over is not None and over <= now:
            out += [(r.alert, metric, topic, instance, _time(over), None, GONE, pd.NaT, r.severity, r.summary) for r in s.active()]
            state.remove()
        else:
            state.update(s.stored())
            nexts = [*s.waiting, *([over] if over is not None else [])]
            state.setTimeoutTimestamp(max(now + 1, min(nexts)))
        if out:
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame["value"] = frame["value"].astype("float64")
            yield frame

    watched = samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    watched = guarded_filter(watched, F.coalesce(F.col("metric").isin(sorted({r.metric for r in rules})), F.lit(False)), "ts")
    out = watched.groupBy(*SERIES).applyInPandasWithState(run, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumn("severity", severity_default("severity", F.col("state")))
