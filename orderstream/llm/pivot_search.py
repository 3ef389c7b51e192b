"""Operator 12: exact top-k by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it and sorted by that key, so that a block is
an annulus round a pivot. For a query at distance D from the pivot, a row at distance d in [low, high] is at least
gap = max(0, D - high, low - D) away (triangle inequality), so its score is at most
(|q|^2 + |v|^2 - gap^2) / 2; and q.v = q.p + q.(v - p) is at most q.p + |q| * high. A query expands annuli in order of
that bound and stops where it falls below its k-th best score. First a query searches the annuli that lie beside
it in the sorted index; the k-th best score found there is its first limit. Then all blocks are searched
in rounds of growing size, each with the limits of the one before.

Bounds only save work. Where vectors have no structure (random directions) they can't exclude much, and
the search is then a blocked scan of the query set against all rows.

Defined cases: vectors that are null, or hold null or non-finite components, take no part (nor do those too
long for 64-bit scores, see ``vector_blocks.clean``); vectors of different length meet as if filled up with
zeros. Of query rows with one id the one whose components' bytes sort first asks, and no row of its id is among
its candidates; other repeated rows are candidates each. Rows without an id are candidates, and sort last
among ties. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderstream.llm import vector_blocks as VB
from orderstream.llm.common import map_arrow, written

PIVOTS = 64

_HIT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
HITS = "query_id long, vec_id long, score long"


def fit_pivots(points: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Whole numbers near the centres of a sample: at most ``n`` different rows."""
    return np.unique(np.rint(VB.centres(points, n)), axis=0) if len(points) else np.zeros((1, points.shape[1]))


def to_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to all pivots."""
    x = rows.astype(np.float64)
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T))


def nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivot, distance): the distance is taken from the difference, which loses no digits near the pivot."""
    cell = to_pivots(rows, pivots).argmin(1)
    return cell, VB.norms(rows.astype(np.float64) - pivots[cell])


def annulus_bounds(batch: VB.Batch, queries: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Upper bounds (queries x blocks) of the scores of an annulus' rows; rounding errors are made up for."""
    size, products = VB.norms(queries), queries @ pivots.T
    away = np.stack([VB.norms(queries - p) for p in pivots], 1)[:, batch.cell]
    gap = np.maximum(0, np.maximum(away - batch.high, batch.low - away))
    squares = (size * size)[:, None] + (batch.most * batch.most)[None, :]
    slack = 1 + 1e-9 * (squares + away * away + (batch.high * batch.high)[None, :])
    by_gap = (squares - gap * gap) / 2
    by_product = products[:, batch.cell] + size[:, None] * batch.high[None, :]
    return np.minimum(by_gap, by_product) + slack


def _search(batch: VB.Batch, ints: np.ndarray, ids: np.ndarray, floor: np.ndarray, bounds: np.ndarray, k: int) -> VB.Best:
    queries, best = ints.astype(np.float64), VB.Best(floor, k)
    longest = float(VB.norms(ints).max()) if len(ints) else 0.0

    def scan(q, b):
        s = batch.scores(b, queries[q], longest)
        s[ids[q][:, None] == batch.ids[b][None, :]] = VB.NONE
        best.add(q, s, batch.ids[b])

    VB.expand(bounds, lambda q, b: bounds[q, b] >= best.floor[q], scan)
    return best


def _at_home(pivots: np.ndarray, dim: int, every: int, k: int):
    """Each query (id divisible by ``every``) against the annuli of its pivot that lie beside it in the index."""
    schema = pa.schema([("id", pa.int64()), ("ints", pa.binary()), ("floor", pa.int64())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            batch = VB.Batch(b, dim)
            own = [(block, i) for block, ids in enumerate(batch.ids) for i in np.flatnonzero((ids % every == 0) & (ids != VB.NO_ID))]
            if not own:
                continue
            ints = np.stack([batch.rows[block][i] for block, i in own])
            ids, home = np.array([batch.ids[block][i] for block, i in own]), np.array([block for block, _ in own])
            bounds = annulus_bounds(batch, ints.astype(np.float64), pivots)
            bounds[batch.cell[home][:, None] != batch.cell[None, :]] = -np.inf
            best = _search(batch, ints, ids, np.full(len(ids), VB.NONE), bounds, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([x.tobytes() for x in ints], pa.binary()), pa.array(best.score[:, -1])], schema=schema)

    return run


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, vec_id: str = "vec_id", vector: str = "embedding",
          pivots: int = PIVOTS, rounds: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of highest integer score for each query, a row whose id is divisible
    by ``every``; ties go to the smaller id."""
    spark = embeddings.sparkSession
    rows = written(spark, VB.clean(embeddings, vec_id, vector, scale), "search-rows")
    total, longest = rows.agg(F.count(F.lit(1)), F.max(F.octet_length("ints"))).first()
    dim = max(1, (longest or 0) // 4)
    at = fit_pivots(VB.sample(rows, total, dim), pivots)
    blocks = VB.build(rows, dim, rounds or VB.rounds_of(total), lambda x: nearest(x, at))
    home = map_arrow(blocks.df.drop("round"), _at_home(at, dim, every, k), "id long, ints binary, floor long")
    queries = written(spark, home.groupBy("id").agg(F.min(F.struct("ints", "floor")).alias("q")).select("id", "q.ints", "q.floor"), "search-queries")
    kind, hits = VB.record(dim, [("floor", 1)]), None

    def held_against(batch, records):
        ints = records["ints"]
        best = _search(batch, ints, records["id"], records["floor"], annulus_bounds(batch, ints.astype(np.float64), at), k)
        q, ids, score = best.rows()
        return records["id"][q], VB.named(ids), score

    for r in range(blocks.rounds):
        files = VB.write_queries(queries, dim, [("floor", 1)], ["id"], "search-query-files")
        new = written(spark, VB.search(blocks.of_round(r), dim, files, kind, held_against, HITS, _HIT), "search-hits")
        hits = new if hits is None else hits.unionByName(new)
        if r + 1 < blocks.rounds:
            found = VB.kth(hits.withColumnRenamed("query_id", "id"), ["id"], k)
            queries = written(spark, queries.join(found, "id", "left").withColumn("floor", F.greatest("floor", "found")).drop("found"), "search-queries")
    return ranked(hits, ["query_id"], k)


def ranked(hits: DataFrame, by: list[str | Column], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
