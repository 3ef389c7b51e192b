"""Joins of many rows with one row of a key, where one key may hold a large part of all rows.

A key is hot if it holds more than its share, a 1,024th of all rows, and more rows than ``floor``: so there
are fewer than 1,024 hot keys at any size of the input. They alone come to the driver
and are broadcast. A hot key's rows are dealt to as many parts as they hold shares; its
row on the other side is copied to each part, fewer than 2,048 copies in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARES = 1024
#: So many rows of a key are no burden to a task.
FLOOR = 50_000


def hot_keys(sizes: DataFrame, keys: list[str], size: str, floor: int = FLOOR, total: int | None = None) -> DataFrame | None:
    """(keys, parts) of the hot keys of ``sizes``, which has a row for each key (``size``: its rows, ``total`` in all); None
    if there are none."""
    if total is None:
        total = sizes.agg(F.sum(size)).first()[0] or 0
    if total <= floor:
        return None
    share = max(total // SHARES, floor, 1)
    hot = sizes.where(F.col(size) > share).select(*keys, F.ceil(F.col(size) / F.lit(share)).cast("int").alias("parts"))
    found = hot.collect()  # fewer than SHARES
    return sizes.sparkSession.createDataFrame(found, hot.schema) if found else None


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame | None, salt: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each key; ``how`` is inner or left. ``salt``: a column of ``rows``
    that differs among the rows of a key."""
    if hot is None:
        return rows.join(table, keys, how)
    parts, hot = F.col("parts"), F.broadcast(hot)
    dealt = (rows.join(hot, keys, "left").withColumn("part", F.when(parts.isNull(), 0).otherwise(F.pmod(F.xxhash64(salt), parts)).cast("int"))
             .drop("parts"))
    copied = (table.join(hot, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1)))
              .drop("parts"))
    return dealt.join(copied, [*keys, "part"], how).drop("part")


def block_of(salt: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(salt), blocks).cast("int")
