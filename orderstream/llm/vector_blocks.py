"""Integer vectors in sorted blocks, and the exact search over them that operators 11 and 12 share.

Rows are cleaned to integer components, keyed by the nearest of a few reference points and their
distance or angle to it, sorted by key over all tasks and packed into blocks of neighbours. A block
knows its hull: what a bound of its rows' scores needs. Queries are written as
plain record files of a bounded number of rows, which tasks map into memory; a task reads its
blocks in batches and holds every file against them. Memory is bounded by a batch and a file,
whatever the number of rows or queries. All scores are exact integers; bounds only skip work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, shared_arrays, write_file, written
from orderstream.session import scratch_path

#: Rows of a block, and its bytes at most (one row at least).
BLOCK_ROWS, BLOCK_BYTES = 256, 1 << 20
#: Queries of a file, and its bytes at most (one query at least).
FILE_QUERIES, FILE_BYTES = 2048, 4 << 20
#: Rows that reference points are fitted on; they change costs only, never results.
SAMPLE_ROWS = 8192
#: No score (scores stay below 2**62 in size), no id (sorts last).
NONE, NO_ID = -(1 << 62) - 1, (1 << 63) - 1
#: Below this product of lengths, every partial sum of a dot product is an integer that a double holds.
DOUBLE_EXACT = 2.0**52


def _flat(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A list column as (values, first value and length of each row); null lists have length -1, null components are NaN."""
    column = column.cast(pa.list_(pa.float64()))
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = np.asarray(column.values.fill_null(np.nan), dtype=np.float64)
    length = np.where(np.asarray(column.is_null()), -1, np.diff(offsets))
    return values, offsets[:-1], length


def clean(df: DataFrame, vec_id: str, vector: str, scale: int, label: str | None = None) -> DataFrame:
    """``id long, label long, ints binary`` (32-bit components floor(scale * x)). Rows whose vector is null, holds a
    null or non-finite component, or is too long for 64-bit scores (a component of 2**31 or a squared length
    of 2**62 after scaling) are left out; with ``label``, so are rows without one."""
    names = [F.col(f"`{vec_id}`").cast("long").alias("id"), (F.lit(0) if label is None else F.col(f"`{label}`")).cast("long").alias("label"),
             F.col(f"`{vector}`").alias("v")]
    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("ints", pa.binary())])

    def run(batches):
        for batch in batches:
            values, starts, length = _flat(batch.column("v"))
            out = []
            for i, (at, n) in enumerate(zip(starts.tolist(), length.tolist(), strict=True)):
                x = values[at:at + max(n, 0)]
                if n < 0 or not np.isfinite(x).all():
                    continue
                x = np.floor(x * scale)
                if n and (np.abs(x).max() >= 2.0**31 or x @ x >= 2.0**62):
                    continue
                out.append((i, x.astype("<i4").tobytes()))
            kept = pa.array([i for i, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(kept), batch.column("label").take(kept), pa.array([x for _, x in out], pa.binary())], schema=schema)

    return map_arrow(df.select(*names).where(F.col("label").isNotNull()), run, "id long, label long, ints binary")


def matrix(ints, dim: int) -> np.ndarray:
    """Rows of components, shorter vectors filled up with zeros."""
    out = np.zeros((len(ints), dim), np.int32)
    for i, x in enumerate(ints):
        out[i, :len(x) // 4] = np.frombuffer(x, "<i4")
    return out


def norms(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    return np.sqrt((x * x).sum(1))


def sample(rows: DataFrame, total: int, dim: int) -> np.ndarray:
    """About ``SAMPLE_ROWS`` rows by a hash of the id, twice as many at most."""
    part = min(1 << 30, -(-(SAMPLE_ROWS << 30) // max(1, total)))
    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < part).limit(2 * SAMPLE_ROWS).collect()
    return matrix([r.ints for r in sorted(picked, key=lambda r: (r.id is None, r.id or 0, r.ints))], dim)


def centres(points: np.ndarray, n: int, turns: int = 8) -> np.ndarray:
    """At most ``n`` centres of the points by Lloyd's iterations from evenly dealt ones."""
    points = np.unique(points, axis=0).astype(np.float64)
    at = points[np.linspace(0, len(points) - 1, min(n, len(points))).astype(int)]
    for _ in range(turns):
        near = ((at * at).sum(1) - 2 * points @ at.T).argmin(1)
        for c in range(len(at)):
            own = points[near == c]
            if len(own):
                at[c] = own.mean(0)
    return at


BLOCK = ("label long, cell int, low double, high double, rows int, least double, most double, round int, ids binary, ints binary, hull binary")
_BLOCK_ARROW = pa.schema([("label", pa.int64()), ("cell", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("rows", pa.int32()),
                          ("least", pa.float64()), ("most", pa.float64()), ("round", pa.int32()), ("ids", pa.binary()), ("ints", pa.binary()), ("hull", pa.binary())])


def rounds_of(total: int, growth: int = 16, first: int = 1 << 16) -> int:
    """Rounds that a search is cut into: each reads ``growth`` times the blocks of the one before, the first about ``first`` rows."""
    n = 1
    while total > first:
        n, total = n + 1, total // growth
    return n


@dataclass
class Blocks:
    """``df``: the written blocks (columns of ``BLOCK``); ``low`` and ``high`` are the block's range of keys, ``least`` and ``most`` of lengths."""

    df: DataFrame
    dim: int
    rounds: int

    def of_round(self, r: int) -> DataFrame:
        return self.df.where(F.col("round") == r)


def build(rows: DataFrame, dim: int, rounds: int, keyed: Callable, hull: Callable | None = None, growth: int = 16) -> Blocks:
    """Blocks of cleaned ``rows`` sorted by label, cell and key. ``keyed(rows matrix)`` gives each row's cell and key,
    ``hull(rows matrix)`` the bytes a block keeps for its bounds. A block's round is drawn at random, so that
    the rounds before the last see a sample of all blocks."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("ints", pa.binary()), ("cell", pa.int32()), ("at", pa.float64())])

    def key(batches):
        for batch in batches:
            if batch.num_rows:
                cell, at = keyed(matrix(batch.column("ints").to_pylist(), dim))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "ints")), pa.array(cell, pa.int32()), pa.array(at, pa.float64())], schema=schema)

    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, 4 * dim)))

    def pack(batches):
        task, made = TaskContext.get().partitionId(), 0

        def block(label, cell, held):
            nonlocal made
            held.sort(key=lambda h: NO_ID if h[0] is None else h[0])  # of equal scores the first is the smallest id
            rows = matrix([h[1] for h in held], dim)
            size, draw = norms(rows), np.random.default_rng((task, made)).random()
            made += 1
            r = next((i for i in range(rounds - 1) if draw < float(growth) ** (i + 1 - rounds)), rounds - 1)
            ids = np.array([NO_ID if h[0] is None else h[0] for h in held], np.int64)
            return (label, cell, min(h[2] for h in held), max(h[2] for h in held), len(held), float(size.min()), float(size.max()), r,
                    ids.tobytes(), rows.tobytes(), hull(rows) if hull else None)

        def blocks():
            held, of = [], None
            for batch in batches:
                for i, label, ints, cell, at in zip(*(batch.column(c).to_pylist() for c in schema.names), strict=True):
                    if held and ((label, cell) != of or len(held) == most):
                        yield block(*of, held)
                        held = []
                    of = label, cell
                    held.append((i, ints, at))
            if held:
                yield block(*of, held)

        out, size = [], 0
        for b in blocks():
            out.append(b)
            size += len(b[9])
            if size >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _BLOCK_ARROW.types, strict=True)], schema=_BLOCK_ARROW)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _BLOCK_ARROW.types, strict=True)], schema=_BLOCK_ARROW)

    keys = ["label", "cell", "at", F.xxhash64("id", "ints")]  # equal vectors are dealt out by id
    dealt = map_arrow(rows, key, "id long, label long, ints binary, cell int, at double").repartitionByRange(*keys).sortWithinPartitions(*keys)
    return Blocks(written(rows.sparkSession, map_arrow(dealt, pack, BLOCK), "vector-blocks"), dim, rounds)


class Batch:
    """Blocks of an Arrow batch as arrays."""

    def __init__(self, batch: pa.RecordBatch, dim: int):
        self.label, self.cell, self.low, self.high, self.least, self.most = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "cell", "low", "high", "least", "most"))
        self.ids = [np.frombuffer(x, np.int64) for x in batch.column("ids").to_pylist()]
        self.rows = [np.frombuffer(x, "<i4").reshape(len(i), dim) for i, x in zip(self.ids, batch.column("ints").to_pylist(), strict=True)]
        self.hull = batch.column("hull").to_pylist()
        self._doubles: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.ids)

    def scores(self, b: int, queries: np.ndarray, longest: float) -> np.ndarray:
        """Exact 64-bit scores of some queries (a matrix of integers held as doubles) and all rows of block ``b``."""
        if longest * self.most[b] >= DOUBLE_EXACT:
            return queries.astype(np.int64) @ self.rows[b].astype(np.int64).T
        if b not in self._doubles:
            self._doubles[b] = np.ascontiguousarray(self.rows[b].T, dtype=np.float64)
        return (queries @ self._doubles[b]).astype(np.int64)


class Best:
    """The ``k`` best (score, id) of each of ``n`` queries; ``floor``: the lowest score that still counts."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor.astype(np.int64).copy(), k
        self.score = np.full((len(floor), k), NONE, np.int64)
        self.ids = np.full((len(floor), k), NO_ID, np.int64)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some queries and of rows in order of their ids; ``NONE`` doesn't count. ``scores`` is used up."""
        top = scores.max(1) if scores.shape[1] else np.full(len(queries), NONE)
        hit = np.flatnonzero((top >= self.floor[queries]) & (top > NONE))
        if not len(hit):
            return
        queries, scores = queries[hit], scores[hit]
        found, names, every = np.full((len(hit), self.k), NONE, np.int64), np.full((len(hit), self.k), NO_ID, np.int64), np.arange(len(hit))
        for j in range(min(self.k, scores.shape[1])):
            best = scores.argmax(1)
            found[:, j], names[:, j] = scores[every, best], ids[best]
            scores[every, best] = NONE
        both, ids2 = np.hstack([self.score[queries], found]), np.hstack([self.ids[queries], names])
        order = np.lexsort((ids2, -both), axis=-1)[:, :self.k]
        self.score[queries], self.ids[queries] = np.take_along_axis(both, order, 1), np.take_along_axis(ids2, order, 1)
        self.floor[queries] = np.maximum(self.floor[queries], self.score[queries, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of all that counts."""
        at, j = np.nonzero((self.score > NONE) & (self.score >= self.floor[:, None]))
        return at, self.ids[at, j], self.score[at, j]


def expand(bounds: np.ndarray, wanted: Callable, scan: Callable) -> tuple[int, int]:
    """Holds queries against blocks, each query's blocks in order of their bounds (queries x blocks), 1, 2, 4 ... at a
    time. ``wanted(queries, b)`` says which of them still need block ``b``; ``scan(queries, b)`` does the work. Pairs that
    can't meet have a bound of -inf. Gives the pairs scanned and the pairs there were."""
    rank = np.empty(bounds.shape, np.int32)
    np.put_along_axis(rank, np.argsort(-bounds, axis=1, kind="stable"), np.arange(bounds.shape[1], dtype=np.int32)[None, :], 1)
    possible, scanned, low, width = bounds > -np.inf, 0, 0, 1
    while low < bounds.shape[1]:
        now = (rank >= low) & (rank < low + width) & possible
        for b in np.flatnonzero(now.any(0)):
            queries = np.flatnonzero(now[:, b])
            queries = queries[wanted(queries, b)]
            if len(queries):
                scan(queries, b)
                scanned += len(queries)
        low, width = low + width, 2 * width
    return scanned, int(possible.sum())


def write_queries(queries: DataFrame, dim: int, fields: list[tuple[str, int]], order: list[str], name: str) -> list[tuple[str, int]]:
    """Query rows (``id``, ``ints`` and 64-bit ``fields`` of a column name and a number of values, arrays if it is over 1)
    as record files of at most ``FILE_QUERIES`` rows, sorted by ``order``. Gives (uri, rows): a line for each file, not each query."""
    folder, kind = scratch_path(queries.sparkSession, name), record(dim, fields)
    most = max(1, min(FILE_QUERIES, FILE_BYTES // kind.itemsize))

    def run(batches):
        task, made, held = TaskContext.get().partitionId(), 0, []

        def put():
            uri = f"{folder}/{task}-{made}"
            x = np.zeros(len(held), kind)
            x["ints"] = matrix([h["ints"] for h in held], dim)
            for c in kind.names[1:]:
                x[c] = [h[c] for h in held]
            write_file(uri, x.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(held)], pa.int64())], names=["uri", "n"])

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == most:
                    yield put()
                    held, made = [], made + 1
        if held:
            yield put()

    tasks = max(1, -(-queries.count() // most))
    dealt = queries.select("id", "ints", *[c for c, _ in fields]).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return [(r.uri, r.n) for r in map_arrow(dealt, run, "uri string, n long").collect()]


def record(dim: int, fields: list[tuple[str, int]]) -> np.dtype:
    return np.dtype([("ints", "<i4", (dim,)), ("id", "<i8"), *((c, "<i8") if n == 1 else (c, "<i8", (n,)) for c, n in fields)])


def search(blocks: DataFrame, dim: int, files: list[tuple[str, int]], kind: np.dtype, held_against: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    """Every file of queries against every block: ``held_against(batch, records)`` gives the columns of ``schema``."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            batch = Batch(b, dim)
            for uri, n in files:
                records = shared_arrays.get(uri, kind)
                if len(records) != n:
                    raise RuntimeError(f"{uri} holds {len(records)} of {n} queries")
                columns = held_against(batch, records)
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

    return map_arrow(blocks, run, schema)


def named(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def kth(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k-th best score by ``keys`` as ``found``, where there are k."""
    return hits.groupBy(*keys).agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.size("s") >= k).select(*keys, F.element_at("s", k).alias("found"))

