"""Duplicate suppression with a memory of any length: copies are found days after the first, beyond any watermark.

The keys seen so far are a table in buckets of the key. A micro-batch is dealt to the same buckets and held against them,
so only the batch moves, never the history: its files are read where they are, bucket by bucket. The state store isn't used.

A key's row says which batch brought it. A batch that is repeated sees the table without its own rows and passes on what it
passed on before; a sink that replaces a batch's rows (or ``OnceTable``) then has each key once. Batches come one after the
other, as ``foreachBatch`` calls them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.operators.upsert import dedup_first


class DuplicateHistory:
    def __init__(self, spark: SparkSession, path: str, name: str, key: str = "order_id", order: tuple[str, ...] = ("timestamp",),
                 sink: Callable[[DataFrame, int], None] | None = None, buckets: int = 64):
        """``path``: folder of the history; ``name``: what its table is called in this session's catalog. ``buckets`` is fixed for the
        life of a folder. Of several rows of a key in one batch the first by ``order`` is passed on. Rows without
        a key are passed on all: they can't be told apart."""
        self.spark, self.path, self.name, self.key, self.order, self.sink, self.buckets = spark, path, name, key, order, sink, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (k STRING, batch_id LONG) USING parquet CLUSTERED BY (k) INTO {buckets} BUCKETS LOCATION '{path}'")

    def new_rows(self, df: DataFrame, batch_id: int) -> DataFrame:
        """The rows of a batch whose keys no earlier batch had."""
        known = self.spark.table(self.name).where(F.col("batch_id") < batch_id).select("k")
        first = dedup_first(df.where(F.col(self.key).isNotNull()), self.key, self.order)
        dealt = first.withColumn("_key", F.col(self.key).cast("string")).repartition(self.buckets, "_key")  # as the history lies
        # not an anti join: the optimizer would put that below the repartition, and the history would move
        fresh = dealt.join(known, F.col("_key") == F.col("k"), "left").where(F.col("k").isNull()).drop("_key", "k")
        return fresh.unionByName(df.where(F.col(self.key).isNull()))

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Pass the new rows on to the sink and remember their keys (a ``foreachBatch`` function)."""
        fresh = self.new_rows(df, batch_id).persist()
        try:
            if self.sink:
                self.sink(fresh, batch_id)
            keys = fresh.where(F.col(self.key).isNotNull()).select(F.col(self.key).cast("string").alias("k"), F.lit(int(batch_id)).cast("long").alias("batch_id"))
            keys.repartition(self.buckets, "k").write.insertInto(self.name)  # a file for each bucket
        finally:
            fresh.unpersist()
