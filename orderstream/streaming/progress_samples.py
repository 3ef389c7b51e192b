"""The streaming job's own progress as metric samples, under the names that the alert rules select.

A listener turns each micro-batch into samples of its series: how long the batch took, how often the query has failed, since
when it is up, how far its watermark lags. They are written to the samples table in small lots, so the same
rules judge the job that feeds them.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from orderstream.schema import METRIC_SAMPLE

# Metric names of the rules.
BATCH_MS = "flink_jobmanager_job_lastCheckpointDuration"
FAILURES = "flink_jobmanager_job_numberOfFailedCheckpoints"
UPTIME_MS = "flink_jobmanager_job_uptime"
#: Of this package: behind the newest event time, rows read, rows dropped as late.
LAG_MS, ROWS, LATE = "stream_watermark_lag_ms", "stream_input_rows", "stream_late_rows"


def _time(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


class ProgressSamples(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str, lot: int = 20):
        """``path``: the samples table; ``lot``: samples are written once there are so many, and by ``flush``."""
        self.spark, self.path, self.lot = spark, path, lot
        self.rows: list[tuple] = []
        self.started: dict[str, tuple[str, dt.datetime]] = {}  # by run: instance, since when
        self.failed: dict[str, int] = {}
        self.late: dict[str, int] = {}
        self.lock = threading.Lock()

    def _add(self, instance: str, at: dt.datetime, **values: float) -> None:
        names = {"batch_ms": BATCH_MS, "failures": FAILURES, "uptime_ms": UPTIME_MS, "lag_ms": LAG_MS, "rows": ROWS, "late": LATE}
        with self.lock:
            self.rows += [(names[k], None, instance, at, float(v)) for k, v in values.items()]
            full = len(self.rows) >= self.lot
        if full:
            self.flush()

    def onQueryStarted(self, event) -> None:
        instance, at = event.name or str(event.id), _time(event.timestamp)
        self.started[str(event.runId)] = instance, at
        self._add(instance, at, failures=self.failed.get(instance, 0), uptime_ms=0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        instance, begun = p.name or str(p.id), _time(p.timestamp)
        took = p.durationMs.get("triggerExecution", p.batchDuration)
        at = begun + dt.timedelta(milliseconds=took)
        values = {"batch_ms": took, "failures": self.failed.get(instance, 0), "rows": p.numInputRows,
                  "uptime_ms": (at - self.started.get(str(p.runId), (instance, begun))[1]).total_seconds() * 1000}
        times = p.eventTime or {}
        if "max" in times and "watermark" in times:
            values["lag_ms"] = (_time(times["max"]) - _time(times["watermark"])).total_seconds() * 1000
        self.late[instance] = self.late.get(instance, 0) + sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self._add(instance, at, **values, late=self.late[instance])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        instance, _ = self.started.pop(str(event.runId), (str(event.id), None))
        if event.exception is not None:
            self.failed[instance] = self.failed.get(instance, 0) + 1
        self._add(instance, dt.datetime.now(dt.timezone.utc), failures=self.failed.get(instance, 0), uptime_ms=0)

    def flush(self) -> None:
        """Write what there is."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            rows = [(m, t, i, at.astimezone(dt.timezone.utc).replace(tzinfo=None), v) for m, t, i, at, v in rows]
            self.spark.createDataFrame(rows, METRIC_SAMPLE).coalesce(1).write.mode("append").parquet(self.path)
