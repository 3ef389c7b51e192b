"""Keyed result table on files: an append-only change log plus an upserted view.

A write lands in the partitions of its ``window_date`` and ``batch_id`` with dynamic
partition overwrite, so replaying a batch after a failure rewrites the same
partitions with the same rows (idempotent). A key's rows all lie in one
``window_date``, so a reader that asks for some dates reads those alone. The
current state is ``upsert_latest`` over the log, i.e. the semantics of ``INSERT ...
ON CONFLICT (keys) DO UPDATE SET update_cols``.

The log lives in generations, ``gen=N`` folders. Compaction writes the current state as the
oldest entry of the next generation; the newest complete generation is the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderstream.operators.upsert import upsert_latest
from orderstream.schema import STATS_KEYS, STATS_UPDATE_COLS, USER_ORDER_STATS

SNAPSHOT = -1  # batch_id of a compacted state: older than every batch


class KeyedTable:
    def __init__(self, path: str, keys: Sequence[str] = STATS_KEYS, update_cols: Sequence[str] = STATS_UPDATE_COLS,
                 schema: T.StructType = USER_ORDER_STATS, date_of: str = "window_start"):
        """``date_of``: the key column (a timestamp) whose date partitions the log."""
        if date_of not in keys:
            raise ValueError("date_of must be one of the keys: a key's rows stay in one partition")
        self.path = path.rstrip("/")
        # explicit schema: a log with only empty batches so far still reads
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]
                                   + [T.StructField("window_date", T.DateType(), True), T.StructField("batch_id", T.LongType(), True)])
        self.keys, self.update_cols, self.date_of = tuple(keys), tuple(update_cols), date_of

    def _files(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def _generations(self, spark: SparkSession) -> list[int]:
        """Numbers of the complete generations, oldest first."""
        fs, path = self._files(spark)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(n[4:]) for n in names if n.startswith("gen=")
                      and (n == "gen=0" or fs.exists(made(f"{self.path}/{n}/_SUCCESS"))))

    def _log_path(self, spark: SparkSession) -> str:
        return f"{self.path}/gen={max(self._generations(spark), default=0)}"

    def _write(self, df: DataFrame, batch_id: int, path: str, mode: str = "dynamic") -> None:
        cols = [f.name for f in self.schema.fields if f.name not in ("window_date", "batch_id")]
        (df.select(*cols, F.to_date(F.col(self.date_of)).alias("window_date"), F.lit(int(batch_id)).cast("bigint").alias("batch_id"))
           .write.mode("overwrite").option("partitionOverwriteMode", mode)
           .partitionBy("window_date", "batch_id").parquet(path))

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Upsert one batch (usable directly as a ``foreachBatch`` function)."""
        self._write(df, batch_id, self._log_path(df.sparkSession))

    def exists(self, spark: SparkSession) -> bool:
        """Whether anything was written yet."""
        fs, _ = self._files(spark)
        return fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._log_path(spark)))

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self._log_path(spark))

    def dates(self, spark: SparkSession) -> list:
        """The dates that have rows, newest first (as many as there are days)."""
        return [r[0] for r in self.log(spark).select("window_date").distinct().orderBy(F.col("window_date").desc()).collect()]

    def read(self, spark: SparkSession, since=None) -> DataFrame:
        """Current table state (last write per key wins), of ``since`` and later
        dates if given; other dates' files aren't opened."""
        log = self.log(spark)
        if since is not None:
            log = log.where(F.col("window_date") >= F.lit(since))
        return upsert_latest(log.drop("window_date"), self.keys, self.update_cols, "batch_id")

    def latest(self, spark: SparkSession, windows: int) -> DataFrame:
        """A part of the table that holds its latest ``windows`` windows whole: dates are
        added, newest first, until they have that many different window starts."""
        dates, since = self.dates(spark), None
        for since in dates:
            seen = self.log(spark).where(F.col("window_date") >= F.lit(since)).select(self.date_of).distinct()
            if seen.limit(windows).count() >= windows:
                break
        return self.read(spark, since)

    def compact(self, spark: SparkSession) -> None:
        """Replace the log by the current state. To be called between batches. A
        batch that is replayed afterwards wins over the state, as it did before."""
        new = max(self._generations(spark), default=0) + 1
        self._write(self.read(spark), SNAPSHOT, f"{self.path}/gen={new}", "static")  # marks the folder complete

    def drop_old(self, spark: SparkSession) -> None:
        """Delete the generations that compaction has replaced, once no reader uses them."""
        fs, _ = self._files(spark)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for n in self._generations(spark)[:-1]:
            fs.delete(path(f"{self.path}/gen={n}"), True)
