"""Dashboard totals that are kept up to date instead of computed anew.

Each batch of the keyed result table says what its keys are now. The change it makes - the new rows less what the table
had for the same keys - is summed by user and by window and appended to a log of changes; totals are sums of
that log, which compaction folds into one entry per user and window. A batch reads the table for its own keys only: the dates
it touches, joined with its keys. Amounts are decimals, so that what was added can be taken away again exactly.

Writing a batch again replaces its changes by the same ones, since they are taken against the batches before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.operators.upsert import upsert_latest
from orderstream.sources.folders import drop, exists, mark, numbered
from orderstream.sources.tables import KeyedTable

FOLDED = -1  # the batch of what compaction has summed up


class MaintainedTotals:
    """``table``: the result table that the batches go to; ``path``: folder of the change logs."""

    GROUPS = {"user": "user_id", "window": "window_start"}

    def __init__(self, table: KeyedTable, path: str, scale: int = 2):
        self.table, self.path, self.money = table, path.rstrip("/"), f"decimal(38,{scale})"

    def _schema(self, group: str) -> str:
        kind = self.table.schema[self.GROUPS[group]].dataType.simpleString()
        return f"{self.GROUPS[group]} {kind}, order_count long, total_amount {self.money}, batch_id long"

    def before(self, df: DataFrame, batch_id: int) -> DataFrame:
        """What the table had for the keys of a batch, from the batches before it."""
        spark, keys = df.sparkSession, list(self.table.keys)
        if not self.table.exists(spark):
            return df.limit(0)
        dates = [r[0] for r in df.select(F.to_date(self.table.date_of).alias("d")).distinct().collect()]
        log = self.table.log(spark).where(F.col("window_date").isin(dates) & (F.col("batch_id") < batch_id))
        return upsert_latest(log.drop("window_date").join(df.select(*keys), keys, "left_semi"), self.table.keys, self.table.update_cols, "batch_id").select(*df.columns)

    def changes(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Each row's keys and by how much a batch changes it."""
        sign = lambda x, n: x.select(*self.table.keys, (F.col("order_count") * n).alias("order_count"),
                                     (F.col("total_amount").cast(self.money) * n).cast(self.money).alias("total_amount"))
        return sign(df, 1).unionByName(sign(self.before(df, batch_id), -1))

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Upsert one batch and add its change to the totals (a ``foreachBatch`` function). A key has one row in a batch."""
        df = df.select(*[f.name for f in self.table.schema.fields if f.name not in ("window_date", "batch_id")]).persist()
        try:
            changes = self.changes(df, batch_id).persist()
            for group, column in self.GROUPS.items():
                summed = self._summed(changes, column).where((F.col("order_count") != 0) | (F.col("total_amount") != 0))
                self._write(summed, group, batch_id, self._generation(df.sparkSession, group))
            changes.unpersist()
            self.table.write_batch(df, batch_id)
        finally:
            df.unpersist()

    def _summed(self, rows: DataFrame, column: str) -> DataFrame:
        return rows.groupBy(column).agg(F.sum("order_count").alias("order_count"), F.sum("total_amount").cast(self.money).alias("total_amount"))

    def _folder(self, group: str, generation: int) -> str:
        return f"{self.path}/{group}/gen={generation}"

    def _generation(self, spark: SparkSession, group: str) -> int:
        return max(numbered(spark, f"{self.path}/{group}", "gen"), default=0)

    def _write(self, summed: DataFrame, group: str, batch_id: int, generation: int) -> None:
        summed.write.mode("overwrite").parquet(f"{self._folder(group, generation)}/batch_id={int(batch_id)}")

    def _log(self, spark: SparkSession, group: str) -> DataFrame:
        path = self._folder(group, self._generation(spark, group))
        return spark.read.schema(self._schema(group)).parquet(path) if exists(spark, path) else spark.createDataFrame([], self._schema(group))

    def _totals(self, spark: SparkSession, group: str) -> DataFrame:
        column = self.GROUPS[group]
        return self._summed(self._log(spark, group), column).where("order_count != 0").select(
            column, "order_count", F.col("total_amount").cast("double").alias("total_amount"))

    def by_user(self, spark: SparkSession) -> DataFrame:
        """``user_id, order_count, total_amount`` over all windows: rows for ``analytics.top_users`` and ``analytics.kpis``."""
        return self._totals(spark, "user")

    def by_window(self, spark: SparkSession) -> DataFrame:
        """``window_start, order_count, total_amount`` over all users: rows for the time series."""
        return self._totals(spark, "window")

    def compact(self, spark: SparkSession) -> None:
        """Fold the changes so far into one entry; between batches. The last batch stays apart, it can be replayed."""
        for group, column in self.GROUPS.items():
            now = self._generation(spark, group)
            log = self._log(spark, group)
            last = log.agg(F.max("batch_id")).first()[0]
            if last is None:
                continue
            self._write(self._summed(log.where(F.col("batch_id") < last), column), group, FOLDED, now + 1)
            self._write(log.where(F.col("batch_id") == last).drop("batch_id"), group, last, now + 1)
            mark(spark, f"{self._folder(group, now + 1)}/_SUCCESS")
            for n in range(now):
                drop(spark, self._folder(group, n))
