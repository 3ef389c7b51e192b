"""Exact percentiles of any number of distinct values, without a buffer of them.

Rows are counted by value, the counts are range-partitioned by (group, value), and
every partition learns from the partitions' totals how many rows of each of its
groups lie before it. The value at a rank is then found in one partition, so a
group that holds most of the rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstream.session import scratch_path


def exact_percentiles(df: DataFrame, value: str, by: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """(by..., n, p0, p1, ...) for every group with a non-null ``value``: the value at
    rank q * (n - 1), interpolated between neighbours."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    counts = df.where(F.col(value).isNotNull()).select(group.alias("g"), F.col(value).cast("double").alias("v")) \
        .groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    # written with its partition numbers: they must stay the same for totals and ranks
    path = scratch_path(spark, "percentile-counts")
    counts.repartitionByRange(parts, "g", "v").select("*", F.spark_partition_id().alias("part")).write.parquet(path)
    ranged = spark.read.parquet(path)
    totals = ranged.groupBy("g", "part").agg(F.sum("c").alias("t"))  # a row for each group and partition at most
    each = Window.partitionBy("g")
    before = totals.select("g", "part", (F.sum("t").over(each.orderBy("part")) - F.col("t")).alias("before"), F.sum("t").over(each).alias("n"))
    upto = F.sum("c").over(Window.partitionBy("g", "part").orderBy("v"))
    ranks = (ranged.select("g", "part", "v", "c", upto.alias("upto")).join(before, ["g", "part"])
             .select("g", "v", "n", (F.col("before") + F.col("upto") - F.col("c")).alias("first"), (F.col("before") + F.col("upto")).alias("end")))

    def at(rank):
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("end")), F.col("v")))

    aggs = []
    for i, q in enumerate(quantiles):
        place = F.lit(float(q)) * (F.col("n") - 1)
        aggs += [at(F.floor(place)).alias(f"lo{i}"), at(F.ceil(place)).alias(f"hi{i}")]
    found = ranks.groupBy("g").agg(F.first("n").alias("n"), *aggs)
    out = []
    for i, q in enumerate(quantiles):
        place = F.lit(float(q)) * (F.col("n") - 1)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(place) - place) * lo + (place - F.floor(place)) * hi).alias(f"p{i}"))
    return found.select(*[F.col("g")[c].alias(c) for c in by], "n", *out)
