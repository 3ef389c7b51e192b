"""Connected components of links, by smallest labels with pointer jumping.

Every round gives a vertex the smallest among its neighbours' labels and its own label's
label, which halves long paths. Rounds are written to the shared folder; only the number
of changed vertices, and the few vertices with a large part of all links or labels, reach the
driver; their joins are spread over tasks. Neighbours are folded with min() and never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import written
from orderstream.llm.spread import FLOOR, hot_keys, join_spread


def connected_components(links: DataFrame, known: DataFrame | None = None, floor: int = FLOOR) -> DataFrame:
    """(v, component) for every vertex of ``links`` (a, b); the component is named by
    its smallest vertex. ``known``: components of a part of the links, of which only
    the links between different ones are looked at again."""
    spark = links.sparkSession
    edges = links.select("a", "b")
    if known is not None:
        for end in ("a", "b"):
            k = known.select(F.col("v").alias("kv"), F.col("component").alias("kc"))
            edges = edges.join(k, edges[end] == k["kv"], "left").withColumn(end, F.coalesce("kc", end)).drop("kv", "kc")
        edges = edges.where("a != b")
    both = written(spark, edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    first = written(spark, both.groupBy("a").agg(F.min("b").alias("n"), F.count(F.lit(1)).alias("links"))
                    .select(F.col("a").alias("v"), F.least("a", "n").alias("l"), "links"), "labels")
    vertices = first.count()
    hub = hot_keys(first.select(F.col("v").alias("b"), "links"), ["b"], "links", floor)
    labels = first.select("v", "l")
    while True:
        heard = (join_spread(both, labels.select(F.col("v").alias("b"), F.col("l").alias("bl")), ["b"], hub, "a")
                 .groupBy("a").agg(F.min("bl").alias("n")))
        lower = labels.join(heard, labels["v"] == heard["a"]).select("v", "l", "n")
        shared = hot_keys(labels.groupBy("l").agg(F.count(F.lit(1)).alias("of")), ["l"], "of", floor, vertices)
        upper = labels.select(F.col("v").alias("l"), F.col("l").alias("ll"))
        new = written(spark, join_spread(lower, upper, ["l"], shared, "v")
                      .select("v", F.col("l").alias("was"), F.least("n", "ll").alias("l")), "labels")
        changed = new.where("l != was").limit(1).count()
        labels = new.select("v", "l")
        if not changed:
            break
    found = labels.select("v", F.col("l").alias("component"))
    if known is None:
        return found
    f = found.select(F.col("v").alias("fv"), F.col("component").alias("fc"))
    sizes = known.groupBy("component").agg(F.count(F.lit(1)).alias("of"))
    old = (join_spread(known, f.withColumnRenamed("fv", "component"), ["component"], hot_keys(sizes, ["component"], "of", floor, known.count()), "v", "left")
           .select("v", F.coalesce("fc", "component").alias("component")))
    fresh = found.join(known, "v", "left_anti")
    return written(spark, old.unionByName(fresh.select("v", "component")), "components")
