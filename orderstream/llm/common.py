"""Helpers that the corpus operators share: reading, column names, Arrow passes, shared files."""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under the shared checkpoint folder: lineage ends
    there, and a lost executor costs no recomputation of what came before."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def unused(columns: list[str], stem: str) -> str:
    """A column name that ``columns`` doesn't have (names compare without case)."""
    taken = {c.lower() for c in columns}
    name = stem
    while name.lower() in taken:
        name = f"{stem}_{uuid.uuid4().hex[:6]}"
    return name


def text_or_empty(column: str):
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def fold(id_column, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds))


def sliced(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` has about ``max_bytes`` at most
    (one row at least), so that Python-side working memory has a bound."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


#: Bytes of an Arrow batch: what a task and its Python worker hold at a time, some copies of it each.
BATCH_BYTES = 8 << 20


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` with batches of a bounded size in bytes, however long the texts are."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(name).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared folder's URI, from any process."""
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file:///") else "file://" + uri[5:])
    return pafs.LocalFileSystem(), os.path.abspath(uri)


def write_file(uri: str, data) -> None:
    """Write bytes at ``uri`` at once or not at all: a repeated or twice started
    task replaces the file by the same content."""
    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, path)


class SharedArrays:
    """Arrays of shared files in a worker process: memory-mapped where the folder is
    mounted; from other file systems read into memory, the least recently used
    given up beyond ``READ_BYTES``. A file that isn't there is an empty array."""

    READ_BYTES = 256 << 20

    def __init__(self):
        self.mapped: dict[str, np.ndarray] = {}
        self.read: OrderedDict[str, np.ndarray] = OrderedDict()

    def get(self, uri: str, dtype) -> np.ndarray:
        if uri in self.mapped:
            return self.mapped[uri]
        if uri in self.read:
            self.read.move_to_end(uri)
            return self.read[uri]
        fs, path = filesystem(uri)
        info = fs.get_file_info(path)
        if info.type != pafs.FileType.File or not info.size:
            return self._mapped(uri, np.empty(0, dtype))
        if isinstance(fs, pafs.LocalFileSystem):
            return self._mapped(uri, np.memmap(path, dtype=dtype, mode="r"))
        with fs.open_input_file(path) as f:
            self.read[uri] = np.frombuffer(f.read(), dtype)
        while len(self.read) > 1 and sum(x.nbytes for x in self.read.values()) > self.READ_BYTES:
            self.read.popitem(last=False)
        return self.read[uri]

    def _mapped(self, uri: str, array: np.ndarray) -> np.ndarray:
        if len(self.mapped) > 20_000:  # open files
            self.mapped.clear()
        self.mapped[uri] = array
        return array


#: This process's arrays.
shared_arrays = SharedArrays()
