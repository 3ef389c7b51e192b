"""Delayed retries as a running service: a pending table, releases by ledger, publishing.

Ingest is a stream: each micro-batch writes its RETRY rows, as the records they
will be republished as and with the time they fall due, to a folder of the pending table, and its PERMANENT
rows straight to the released one. A release moves pending rows that have fallen due. Both are
plain projections and filters; partitions of the due minute bound what a release
reads. Nothing waits inside a task.

The ledger says, for each micro-batch, up to which due time its rows were released. A batch counts from the
moment its folder is complete and then starts at the beginning of time, so an ingest that ends after a later
release loses nothing. A release takes the rows of (ledger, now] of every batch it knows, writes them to a folder
of its own number and then the next state of the ledger, which ends the release. One that broke off before that is
done again under the same number and replaces what it left. So every row is in exactly one release.
There is one releasing process at a time; ingests may overlap it. A folder belongs to the checkpoint of its ingest, whose
micro-batches its batches are.

Publishing hands complete releases, in order, to a sink that takes (rows, release number) like a ``foreachBatch``
function; its progress is kept apart, so a release is handed on at least once, and once with a
sink such as ``OnceTable.write_batch``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderstream.functions.codec import encode_order_json, kafka_key, with_headers
from orderstream.operators.retry import PERMANENT, RETRY, decode_dlq_records, plan_retries
from orderstream.schema import HEADER, ORDER_TOPIC, RETRY_HEADER
from orderstream.sources.folders import drop, exists, mark, names, numbered

MINUTE_MS = 60_000
BEGINNING = -(2 ** 62)
#: Coordinates are those of the dead-letter record; key, value and headers those of the record to republish.
_FIELDS = [T.StructField(n, t) for n, t in (
    ("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()), ("order_id", T.StringType()),
    ("user_id", T.StringType()), ("key", T.BinaryType()), ("value", T.StringType()), ("headers", T.ArrayType(HEADER)),
    ("retry_count", T.LongType()), ("decision", T.StringType()), ("due_ms", T.LongType()))]
PENDING_SCHEMA = T.StructType([*_FIELDS, T.StructField("batch_id", T.LongType()), T.StructField("due_minute", T.LongType())])
RELEASED_SCHEMA = T.StructType([*_FIELDS, T.StructField("released_ms", T.LongType()), T.StructField("release", T.StringType())])
#: What publishing hands on: the record for the order topic, and where its dead letter came from.
RETRY_RECORD = T.StructType([T.StructField(n, t) for n, t in (
    ("topic", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()), ("key", T.BinaryType()),
    ("value", T.BinaryType()), ("headers", T.ArrayType(HEADER)), ("to_topic", T.StringType()))])
_LEDGER_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("batch_id", "to_ms")])


class ReleaseIncomplete(RuntimeError):
    """The run ended before every pending record was released."""


def with_due_time(planned: DataFrame, now_ms: int | Column) -> DataFrame:
    """Planned rows in the tables' shape. RETRY rows become the record to republish (key, JSON and headers with the
    incremented count) and fall due a backoff after ``now_ms``; PERMANENT rows keep what they came with."""
    retry = F.col("decision") == RETRY
    now = F.lit(now_ms).cast("long") if isinstance(now_ms, int) else now_ms
    due = F.when(F.col("backoff_ms") > F.lit(2 ** 62) - now, F.lit(2 ** 62)).otherwise(now + F.col("backoff_ms"))
    has = set(planned.columns)
    own = {n: F.col(n) if n in has else F.lit(None).cast(t) for n, t in (("key", T.BinaryType()), ("headers", T.ArrayType(HEADER)))}
    headers = with_headers(own["headers"], {RETRY_HEADER: F.col("next_retry_count")})
    return planned.select(
        "topic", "partition", "offset", "order_id", "user_id",
        F.when(retry, kafka_key("user_id")).otherwise(own["key"]).alias("key"),
        F.when(retry, encode_order_json()).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(retry, headers).otherwise(own["headers"]).alias("headers"),
        F.when(retry, F.col("next_retry_count")).otherwise(F.col("retry_count")).alias("retry_count"),
        "decision", F.when(retry, due).alias("due_ms"))


@dataclass
class RetryRelease:
    """The two tables, the ledger between them and the progress of publishing, under one folder."""
    spark: SparkSession
    folder: str
    base_ms: int = 1000
    clock_ms: Callable[[], int] = lambda: int(time.time() * 1000)

    @property
    def pending_path(self) -> str:
        return f"{self.folder}/pending"

    @property
    def released_path(self) -> str:
        return f"{self.folder}/released"

    def ingest(self, records: DataFrame, batch_id: int) -> None:
        """One micro-batch of dead-letter records (a ``foreachBatch`` function)."""
        folder = f"{self.pending_path}/batch_id={int(batch_id)}"
        if exists(self.spark, f"{folder}/_SUCCESS"):
            return
        now = self.clock_ms()
        planned = plan_retries(decode_dlq_records(records).where(~F.col("undecodable")), base_ms=self.base_ms)
        rows = with_due_time(planned, now)
        at_once = rows.where(F.col("decision") == PERMANENT)
        at_once.withColumn("released_ms", F.lit(now).cast("long")).write.mode("overwrite").parquet(f"{self.released_path}/release=batch-{int(batch_id)}")
        retry = rows.where(F.col("decision") == RETRY)
        retry.withColumn("due_minute", F.expr(f"due_ms div {MINUTE_MS}")).write.mode("overwrite").partitionBy("due_minute").parquet(folder)

    def _ledger(self) -> tuple[int, dict[int, int]]:
        """(number of the last release, time up to which each batch was released)."""
        done = numbered(self.spark, f"{self.folder}/ledger", "release_id")
        if not done:
            return 0, {}
        state = self.spark.read.schema(_LEDGER_SCHEMA).parquet(f"{self.folder}/ledger/release_id={done[-1]}").collect()
        return done[-1], {r.batch_id: r.to_ms for r in state}

    def _waiting(self, state: dict[int, int], batches: list[int]) -> DataFrame:
        """The rows of some complete batches that no release has taken."""
        if not batches:
            return self.spark.createDataFrame([], PENDING_SCHEMA)
        since = [(b, state.get(b, BEGINNING)) for b in batches]
        p = self.spark.read.schema(PENDING_SCHEMA).option("basePath", self.pending_path).parquet(*[f"{self.pending_path}/batch_id={b}" for b in batches])
        p = p.where(F.col("due_minute") >= min(t for _, t in since) // MINUTE_MS)
        return p.join(self.spark.createDataFrame(since, "batch_id long, since_ms long"), "batch_id").where(F.col("due_ms") > F.col("since_ms"))

    def _batches(self) -> list[int]:
        return numbered(self.spark, self.pending_path, "batch_id")

    def release(self) -> int | None:
        """Release what is due; the time at which the next row falls due, None if nothing is left."""
        batches, (last, state) = self._batches(), self._ledger()
        now = self.clock_ms()
        waiting = self._waiting(state, batches)
        first, later = waiting.agg(F.min("due_ms"), F.min(F.when(F.col("due_ms") > now, F.col("due_ms")))).first()
        if first is None or first > now:
            return first
        due = waiting.where((F.col("due_minute") <= now // MINUTE_MS) & (F.col("due_ms") <= now))
        due.select(*[f.name for f in _FIELDS], F.lit(now).cast("long").alias("released_ms")).write.mode("overwrite").parquet(
            f"{self.released_path}/release=due-{last + 1}")
        self._close(last + 1, {b: max(now, state.get(b, BEGINNING)) for b in batches})
        return later

    def _close(self, number: int, state: dict[int, int]) -> None:
        self.spark.createDataFrame(list(state.items()), _LEDGER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/ledger/release_id={number}")

    def _marks(self) -> list[int]:
        return [int(n) for n in names(self.spark, f"{self.folder}/published") if n.isdigit()]

    def _published(self) -> int:
        """The last release that was handed on."""
        return max(self._marks(), default=0)

    def publish(self, sink: Callable[[DataFrame, int], None], topic: str = ORDER_TOPIC) -> int:
        """Hand the complete releases that weren't yet handed on to ``sink`` as ``RETRY_RECORD`` rows; how many there were."""
        done, last = self._published(), self._ledger()[0]
        for n in range(done + 1, last + 1):
            rows = self.spark.read.schema(T.StructType(_FIELDS)).parquet(f"{self.released_path}/release=due-{n}")
            sink(rows.select("topic", "partition", "offset", "key", F.col("value").cast("binary").alias("value"), "headers",
                             F.lit(topic).alias("to_topic")), n)
            mark(self.spark, f"{self.folder}/published/{n}")
        return max(0, last - done)

    def drop_released(self) -> None:
        """Delete batches of the pending table that were released whole (the newest two stay, a stream can replay
        them) and the ledger's and publisher's entries before the last. The released table isn't touched."""
        batches, (last, state) = self._batches(), self._ledger()
        left = {r.batch_id for r in self._waiting(state, batches).select("batch_id").distinct().collect()}
        gone = [b for b in batches[:-2] if b not in left and b in state]
        for b in gone:
            drop(self.spark, f"{self.pending_path}/batch_id={b}")
        for n in numbered(self.spark, f"{self.folder}/ledger", "release_id"):
            if n < last:
                drop(self.spark, f"{self.folder}/ledger/release_id={n}")
        done = self._published()
        for n in self._marks():
            if n < done:
                drop(self.spark, f"{self.folder}/published/{n}")

    def released(self) -> DataFrame:
        path = self.released_path
        return self.spark.read.schema(RELEASED_SCHEMA).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], RELEASED_SCHEMA)

    def pending(self) -> int:
        return self._waiting(self._ledger()[1], self._batches()).count()


def start_service(spark: SparkSession, records: DataFrame, table: RetryRelease, sink: Callable[[DataFrame, int], None], checkpoint: str, *,
                  poll: str = "1 second", name: str = "retries") -> list[StreamingQuery]:
    """The running service: one query takes dead-letter records in, the other wakes up every ``poll``, releases what is due
    and publishes it. Both run until they are stopped and go on from their checkpoints and the tables' folders."""
    def wake(_: DataFrame, tick: int) -> None:
        table.release()
        table.publish(sink)
        if tick % 100 == 99:
            table.drop_released()

    ticks = spark.readStream.format("rate").option("rowsPerSecond", "1").load()
    return [records.writeStream.foreachBatch(table.ingest).option("checkpointLocation", f"{checkpoint}/ingest").queryName(f"{name}_ingest").start(),
            ticks.writeStream.foreachBatch(wake).option("checkpointLocation", f"{checkpoint}/release").trigger(processingTime=poll)
            .queryName(f"{name}_release").start()]


def run_release(spark: SparkSession, records_path: str, schema, checkpoint: str, folder: str, *, base_ms: int = 1000,
                stop: Callable[[], bool] = lambda: False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Take in all dead-letter records of a folder and release them as they fall
    due. Ends when nothing is pending. If ``stop`` asks for an earlier end, or the ingest
    fails, it raises: a partial result is never returned."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    table = RetryRelease(spark, folder, base_ms)
    query = (reader.parquet(records_path).writeStream.foreachBatch(table.ingest)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()  # raises what the stream failed with
    while (due := table.release()) is not None:
        if stop():
            raise ReleaseIncomplete(f"stopped with {table.pending()} records pending")
        time.sleep(max(0.0, (due - table.clock_ms()) / 1000))
    return table.released()
