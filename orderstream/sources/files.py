"""File-backed sources and sinks: JSON value streams, DLQ archive, console,
metric-sample tables and load-summary output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.schema import METRIC_SAMPLE


def read_value_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One JSON record value per line -> streaming DataFrame ``value: string``
    (a file stand-in for the topic source; same downstream plan)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def write_values(df: DataFrame, path: str, value: str = "value", mode: str = "append") -> None:
    """Batch-write record values as text lines (feeds ``read_value_stream``)."""
    df.select(F.col(value).cast("string").alias("value")).write.mode(mode).text(path)


def dlq_archive(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Every dead-letter record appended to JSON files (exactly-once file sink)."""
    w = df.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.outputMode("append").start()


def console(df: DataFrame, checkpoint: str | None = None, output_mode: str = "append"):
    """Print every micro-batch (debug sink)."""
    w = df.writeStream.format("console").option("truncate", "false").outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def read_samples(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Metric samples table (parquet), batch or as a file stream."""
    if streaming:
        return spark.readStream.schema(METRIC_SAMPLE).parquet(path)
    return spark.read.parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Load summary as JSON (one small file; the summary is one row per run)."""
    df.coalesce(1).write.mode("overwrite").json(path)
