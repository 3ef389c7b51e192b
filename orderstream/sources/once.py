"""A table that takes every record of a topic once, however often its batches are replayed.

A micro-batch is written in three steps: its rows, into a folder of its own; the (topic, partition,
offset) of those rows, into the ledger; and its commit. A replay of a batch that has its commit does nothing; one
that broke off earlier replaces what it left. Readers see committed batches only.

A job that starts over with a new checkpoint gives its batches new numbers, so a batch is known by the streaming query's
id (kept in its checkpoint) and its number, and rows whose coordinates the ledger already has are dropped. The ledger is
partitioned by ranges of offsets: a batch reads the ranges that its own offsets lie in, not the history. A batch
that spans many ranges puts neighbouring ones into one folder, so that it writes a bounded number of folders however
narrow the ranges are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderstream.sources.folders import exists

#: Offsets of one range of the ledger.
OFFSET_RANGE = 1_000_000
#: Folders of ranges that a batch's part of the ledger has at most.
FOLDERS = 32


class OnceTable:
    def __init__(self, path: str, schema: T.StructType, partition_of: Sequence[str] = ("topic", "partition"), offset: str = "offset",
                 offset_range: int = OFFSET_RANGE, run: str | None = None):
        """``schema``: the columns kept. A record is known by ``partition_of`` and ``offset``; records with a null
        there can't be told apart and are all kept. ``run`` names the writer outside a streaming query."""
        self.path, self.schema, self.offset, self.offset_range, self.run = path.rstrip("/"), schema, offset, offset_range, run
        self.coordinates = (*partition_of, offset)
        kinds = {f.name: f.dataType for f in schema.fields}
        batch = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
        self._rows = T.StructType([*schema.fields, *batch])
        self._ledger = T.StructType([*(T.StructField(c, kinds[c]) for c in self.coordinates), T.StructField("offset_range", T.LongType()),
                                      T.StructField("last_range", T.LongType()), *batch])
        self._commits = T.StructType([T.StructField("rows", T.LongType()), *batch])

    def _run(self, spark: SparkSession) -> str:
        return self.run or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"

    def _table(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.path}/{name}"
        return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)

    def commits(self, spark: SparkSession) -> DataFrame:
        """``rows, run, batch_id`` of the committed batches."""
        return self._table(spark, "commits", self._commits)

    def _committed(self, df: DataFrame) -> DataFrame:
        return df.join(self.commits(df.sparkSession).select("run", "batch_id").distinct(), ["run", "batch_id"], "left_semi")

    def _place(self) -> Column:
        return F.floor(F.col(self.offset) / F.lit(self.offset_range)).cast("long")

    def _ranges(self, df: DataFrame) -> tuple[int | None, int | None]:
        """The first and the last range that the rows' offsets lie in; none without offsets."""
        return tuple(df.agg(F.min(self._place()), F.max(self._place())).first())

    def _write_ledger(self, rows: DataFrame, path: str) -> None:
        """The rows' coordinates in folders of one or more ranges, ``offset_range`` to ``last_range``. Tasks hold
        neighbouring offsets, so that there are about as many files as tasks and folders together."""
        low, high = self._ranges(rows)
        low, wide = (0, 1) if low is None else (low, (high - low) // FOLDERS + 1)
        first = (F.lit(low) + F.floor((self._place() - low) / F.lit(wide)) * wide).cast("long")
        at = rows.where(F.col(self.offset).isNotNull()).select(*self.coordinates, first.alias("offset_range"), (first + (wide - 1)).alias("last_range"))
        at.repartitionByRange(self.offset).write.mode("overwrite").partitionBy("offset_range", "last_range").parquet(path)

    def _unknown(self, df: DataFrame) -> DataFrame:
        """The rows whose coordinates no committed batch has, each once."""
        spark = df.sparkSession
        low, high = self._ranges(df)
        whole = F.lit(True)
        for c in self.coordinates:
            whole = whole & F.col(c).isNotNull()
        fresh = df.where(whole).dropDuplicates(list(self.coordinates))
        if low is not None:
            ledger = self._table(spark, "ledger", self._ledger).where((F.col("offset_range") <= high) & (F.col("last_range") >= low))
            fresh = fresh.join(self._committed(ledger).select(*self.coordinates), list(self.coordinates), "left_anti")
        return fresh.select(*df.columns).unionByName(df.where(~whole))

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """Append one batch (usable as a ``foreachBatch`` function)."""
        spark = df.sparkSession
        at = f"run={self._run(spark)}/batch_id={int(batch_id)}"
        if exists(spark, f"{self.path}/commits/{at}/_SUCCESS"):
            return
        names = [f.name for f in self.schema.fields]
        self.write_rows(self._unknown(df.select(*names)), f"{self.path}/rows/{at}")
        written = spark.read.schema(self.schema).parquet(f"{self.path}/rows/{at}")
        self._write_ledger(written, f"{self.path}/ledger/{at}")
        written.agg(F.count(F.lit(1)).alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{at}")

    def write_rows(self, df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(path)

    def read(self, spark: SparkSession) -> DataFrame:
        """All committed rows."""
        return self._committed(self._table(spark, "rows", self._rows)).select(*[f.name for f in self.schema.fields])
