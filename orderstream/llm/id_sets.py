"""A set of ids as sorted arrays in the shared folder, for filters without a shuffle.

Asking which rows belong to a large set of ids would move every row, texts and
all, to meet its id. Instead the ids alone are dealt to shards, sorted and written as
plain files; workers map the files into memory and test their own rows. Integer ids
stand for themselves, others by their 64-bit hash, whose rare false hits the
caller has to bear or to join away.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, shared_arrays, write_file
from orderstream.session import scratch_path


def id_number(column: Column, kind: str) -> Column:
    return column.cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(column)


@dataclass
class IdSet:
    folder: str
    shards: int

    def contains(self, ids: np.ndarray) -> np.ndarray:
        out, shard = np.zeros(len(ids), bool), ids & (self.shards - 1)
        for s in np.unique(shard):
            own = np.flatnonzero(shard == s)
            out[own] = self._in_shard(int(s), ids[own])
        return out

    def _in_shard(self, s: int, ids: np.ndarray) -> np.ndarray:
        keys = shared_arrays.get(f"{self.folder}/{s}", np.int64)
        if not len(keys):
            return np.zeros(len(ids), bool)
        return keys[np.minimum(np.searchsorted(keys, ids), len(keys) - 1)] == ids


def write_id_set(ids: DataFrame, column: str, name: str) -> IdSet:
    """The ids in ``column``; nulls and repeats don't matter."""
    spark = ids.sparkSession
    kind = ids.schema[column].dataType.simpleString()
    numbers = ids.where(F.col(column).isNotNull()).select(id_number(F.col(column), kind).alias("n"))
    shards = 1 << max(4, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    out = IdSet(scratch_path(spark, name), shards)

    def write(batches):
        held: dict[int, list] = {}
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False)
            for s in np.unique(n & (shards - 1)):
                held.setdefault(int(s), []).append(n[n & (shards - 1) == s])
        for s, parts in held.items():
            keys = np.unique(np.concatenate(parts))
            write_file(f"{out.folder}/{s}", keys.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([len(keys)], pa.int64())], names=["n"])

    map_arrow(numbers.repartition(shards, F.col("n").bitwiseAND(F.lit(shards - 1))), write, "n long").agg(F.sum("n")).collect()
    return out


def keep_members(df: DataFrame, number: str, members: IdSet) -> DataFrame:
    """The rows of ``df`` whose ``number`` (see ``id_number``) is in the set."""
    def run(batches):
        for batch in batches:
            n = batch.column(number)
            keep = members.contains(n.fill_null(0).to_numpy(zero_copy_only=False)) & ~n.is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(keep))

    return map_arrow(df, run, df.schema)
