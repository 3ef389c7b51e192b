"""Folders of any store that Spark reads: does one exist, what does it hold."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def numbered(spark: SparkSession, path: str, stem: str) -> list[int]:
    """The numbers N of the complete ``stem=N`` folders under a path, in order."""
    found = sorted(int(n.removeprefix(f"{stem}=")) for n in names(spark, path) if n.startswith(f"{stem}="))
    return [n for n in found if exists(spark, f"{path}/{stem}={n}/_SUCCESS")]


def drop(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty folder, at once or not at all."""
    fs, p = _at(spark, path)
    fs.mkdirs(p)
