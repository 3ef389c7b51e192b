"""The order-event streaming job: decode -> validate/split -> watermark ->
PLACED filter -> per-user tumbling stats -> idempotent keyed sink, with the
dead-letter branch written from the same tagged definition."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderstream.operators.upsert import dedup_streaming
from orderstream.operators.validate import decode_events, status_is, tag_events
from orderstream.operators.windows import guarded_filter, watermark_by_split, windowed_stats
from orderstream.schema import PLACED, WATERMARK_DELAY, WINDOW
from orderstream.session import apply_core_conf, checkpoint_root


def tagged_events(values: DataFrame, value: str = "value", keep: tuple[str, ...] = (),
                  on_malformed: str = "dlq") -> DataFrame:
    """Record values -> typed, tagged events (``dlq_reason`` null = valid)."""
    return tag_events(decode_events(values, value, keep, on_malformed))


def order_stats_plan(values: DataFrame | Sequence[DataFrame], *, value: str = "value", delay: str = WATERMARK_DELAY,
                     width: str = WINDOW, status: str = PLACED, key: str = "user_id",
                     guard: bool = True, dedup: bool = False, exact: bool = False,
                     on_malformed: str = "dlq") -> DataFrame:
    """Windowed per-key stats of valid events with ``status``.

    The watermark is taken over *all* decoded events (bad and non-matching ones
    advance event time too); ``guard`` keeps the validity/status filter above
    the watermark node so the optimizer cannot push it below. ``values`` may be
    several streams, one for each split of the source: each has its own watermark then.
    """
    splits = [values] if isinstance(values, DataFrame) else values
    wm = watermark_by_split([tagged_events(v, value, on_malformed=on_malformed) for v in splits], "event_time", delay)
    pred = F.col("dlq_reason").isNull() & status_is(status)
    kept = guarded_filter(wm, pred) if guard else wm.where(pred)
    if dedup:
        kept = dedup_streaming(kept)
    return windowed_stats(kept, key=key, width=width, exact=exact)


def dlq_plan(values: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Dead-letter branch: every event with a reason, plus the raw value and, where
    the records have them, key and headers (the retry count travels there)."""
    own = tuple(c for c in ("key", "headers") if c in values.columns and c not in keep)
    t = tagged_events(values, value, keep=keep + own + (value,))
    return t.where(F.col("dlq_reason").isNotNull())


def start_order_job(spark: SparkSession, values: DataFrame, stats_sink: Callable[[DataFrame, int], None],
                    dlq_sink: Callable[[DataFrame, int], None] | None = None, *, name: str = "orders",
                    checkpoint: str | None = None, trigger: dict | None = None, **plan_kw) -> list[StreamingQuery]:
    """Start the stats query (append mode: a window is emitted once, when the
    watermark passes its end) and, if given, the dead-letter query.  Each has
    its own checkpoint under the shared checkpoint folder."""
    apply_core_conf(spark)
    root = (checkpoint or f"{checkpoint_root(spark).rstrip('/')}/{name}").rstrip("/")
    trig = trigger or {"processingTime": "30 seconds"}
    stats = order_stats_plan(values, **plan_kw)
    qs = [stats.writeStream.outputMode("append").foreachBatch(stats_sink)
          .option("checkpointLocation", f"{root}/stats").trigger(**trig).queryName(f"{name}_stats").start()]
    if dlq_sink is not None:
        qs.append(dlq_plan(values).writeStream.outputMode("append").foreachBatch(dlq_sink)
                  .option("checkpointLocation", f"{root}/dlq").trigger(**trig).queryName(f"{name}_dlq").start())
    return qs


def start_split_job(spark: SparkSession, records: DataFrame, valid_sink: Callable[[DataFrame, int], None],
                    dlq_sink: Callable[[DataFrame, int], None], *, value: str = "value", name: str = "split", checkpoint: str | None = None,
                    trigger: dict | None = None) -> StreamingQuery:
    """Valid events and dead letters from one query with one checkpoint: both outputs are always at the same offsets.

    A micro-batch is decoded and tagged once; its dead letters are written first, then its valid rows are handed
    on. Both sinks get the tagged events with the record's own columns and the number of the batch; if the job ends between the
    two, the batch comes again as a whole, so each sink must know a batch that it has (``OnceTable.write_batch``).
    """
    apply_core_conf(spark)
    root = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/{name}"
    own = tuple(c for c in ("topic", "partition", "offset", "key", "headers") if c in records.columns)

    def both(tagged: DataFrame, batch_id: int) -> None:
        tagged = tagged.persist()
        try:
            dlq_sink(tagged.where(F.col("dlq_reason").isNotNull()), batch_id)
            valid_sink(tagged.where(F.col("dlq_reason").isNull()), batch_id)
        finally:
            tagged.unpersist()

    w = tagged_events(records, value, keep=(*own, value)).writeStream.foreachBatch(both).option("checkpointLocation", root).queryName(name)
    return (w.trigger(**trigger) if trigger else w).start()


def dropped_late_rows(q: StreamingQuery) -> int:
    """Rows the watermark dropped as late, summed over the retained progress."""
    n = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            n += int(v or 0)
    return n
