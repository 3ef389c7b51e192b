"""Exact dedup (operator 10).

Texts are grouped by a 128-bit content hash; inside a hash group the grouping key
also holds the text itself, so equal bytes are what makes a group and a collision
of hashes makes two. Copies collapse in every map task before the shuffle: a text
that a third of all rows share reaches the reducers as one row a task; where rows meet
their class again, the rows of such a text are spread over tasks.

Defined cases: a null text counts as empty; empty texts are copies of each other;
a null id is never preferred over another; rows that share id and text are
indistinguishable to the report (all of them carry ``kept`` when theirs is the id
that stays) and ``deduplicate`` keeps one of them; an empty table gives an empty
result; other columns never matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderstream.llm.common import text_or_empty, unused, written
from orderstream.llm.spread import FLOOR, hot_keys, join_spread


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _classes(docs: DataFrame, id_col: str, text_col: str, keep: str, digest: Callable[[Column], Column]) -> DataFrame:
    """hash, text_sha256, keep_id, group_size, variants: a row for each different
    text. ``variants`` counts the texts that share the hash (1 but for collisions)."""
    best = {"min": F.min, "max": F.max}[keep]
    d = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    g = (d.select("id", "text", digest(F.col("text")).alias("hash"))
         .groupBy("hash", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
         .select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    return written(docs.sparkSession, g, "exact-classes")


def group_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                 digest: Callable[[Column], Column] = md5_128, floor: int = FLOOR) -> DataFrame:
    """A row for each input row: id, keep_id, group_size, kept, text_sha256.

    Rows meet their class by the content hash. Only where a hash has several
    texts (none in practice) the rows of that hash are compared by the text's
    digest of 256 bits as well, which the byte-wise grouping has told apart.
    """
    classes = _classes(docs, id_col, text_col, keep, digest)
    collided = classes.groupBy("hash").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1").select("hash")
    text = text_or_empty(text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), digest(text).alias("hash"))
    single = classes
    split = not collided.isEmpty()
    if split:
        single = classes.join(collided, "hash", "left_anti")
    out = join_spread(rows, single, ["hash"], hot_keys(single, ["hash"], "group_size", floor), "id")
    if split:
        several = classes.join(collided, "hash", "left_semi")
        twins = docs.select(F.col(f"`{id_col}`").alias("id"), digest(text).alias("hash"), F.sha2(text, 256).alias("text_sha256"))
        out = out.unionByName(twins.join(several, ["hash", "text_sha256"]))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    classes = _classes(docs, id_col, text_col, keep, digest)
    sha, place = unused(docs.columns, "text_digest"), unused(docs.columns, "place")
    stay = classes.select(F.col("text_sha256").alias(sha), F.col("keep_id"))
    d = docs.withColumn(sha, F.sha2(text_or_empty(text_col), 256))
    kept = d.join(stay, (d[sha] == stay[sha]) & d[id_col].eqNullSafe(stay["keep_id"]), "left_semi")
    one = Window.partitionBy(sha, f"`{id_col}`").orderBy(f"`{id_col}`")
    return kept.withColumn(place, F.row_number().over(one)).where(F.col(place) == 1).drop(sha, place)
