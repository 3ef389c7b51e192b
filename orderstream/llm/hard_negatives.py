"""Operator 11: hard-negative mining with angular triangle bounds.

For each anchor: its best rows of the same label (positives), and for each positive the best rows of another label whose
score lies in a window given by the positive's score (hard negatives).

Every row is keyed by the nearest of a few reference directions and its angle to it, and sorted by label and key into
blocks; a block stores the range of its rows' angles to all reference directions. With an anchor's own angle A and a
row's angle B to one direction, the angle between the two lies in [|A - B|, min(A + B, 2 pi - A - B)]; over all directions
that gives an interval of the cosine, which times the lengths bounds the scores from both sides. Bounds
are widened by more than their rounding errors. Only blocks whose interval meets what an anchor still looks for - a
positive not below its worst one so far, a negative inside a window and not below its worst there -
are scored, in exact integers. Limits come from the blocks beside an anchor in the index, and from round to round.

Defined cases: rows without a label and vectors that are null or hold null or non-finite components take no part (nor do
vectors too long for 64-bit scores, see ``vector_blocks.clean``). Of anchor rows with one id the one whose components'
bytes sort first asks; no row of its id is among its positives. Other repeated rows are rows each. Rows without an
id are no anchors, and sort last among ties. A positive with a score below 0 has no negatives, since its window is empty.
An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstream.llm import vector_blocks as VB
from orderstream.llm.common import map_arrow, written

DIRECTIONS = 32

_POSITIVE = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_NEGATIVE = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                       ("vec_id", pa.int64()), ("score", pa.int64())])


def fit_directions(points: np.ndarray, n: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors towards the centres of a sample."""
    size = VB.norms(points)
    points = points[size > 0] / size[size > 0, None]
    if not len(points):
        return np.eye(1, points.shape[1])
    at = VB.centres(points, n)
    size = VB.norms(at)
    return at[size > 0] / size[size > 0, None] if (size > 0).any() else np.eye(1, points.shape[1])


def angles(rows: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of rows to all directions; a row of zeros is at a right angle to them (its scores are 0 anyway)."""
    x, size = rows.astype(np.float64), VB.norms(rows)
    return np.arccos(np.clip(x @ directions.T / np.where(size > 0, size, 1)[:, None], -1, 1))


def angle_range(rows: np.ndarray, directions: np.ndarray) -> bytes:
    a = angles(rows, directions)
    return np.stack([a.min(0), a.max(0)]).tobytes()


def score_intervals(batch: VB.Batch, anchors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) possible score of each anchor with any row of each block."""
    hull = np.stack([np.frombuffer(h).reshape(2, -1) for h in batch.hull])
    own, size = angles(anchors, directions), VB.norms(anchors)[:, None]
    least, most = np.zeros((len(anchors), len(batch))), np.full((len(anchors), len(batch)), np.pi)
    for r in range(len(directions)):
        a, low, high = own[:, r, None], hull[None, :, 0, r], hull[None, :, 1, r]
        np.maximum(least, np.maximum(low - a, a - high), out=least)
        np.minimum(most, np.where(a + high <= np.pi, a + high, np.where(a + low >= np.pi, 2 * np.pi - a - low, np.pi)), out=most)
    slack = 1 + 1e-7 * size * batch.most  # an angle is good to 2e-8 where it is worst
    up, down = np.cos(least), np.cos(most)
    return (size * down * np.where(down >= 0, batch.least, batch.most) - slack, size * up * np.where(up >= 0, batch.most, batch.least) + slack)


def _positives(batch: VB.Batch, ints, ids, labels, floor, directions, k: int, cells=None) -> VB.Best:
    best, queries = VB.Best(floor, k), ints.astype(np.float64)
    longest = float(VB.norms(ints).max()) if len(ints) else 0.0
    upper = score_intervals(batch, queries, directions)[1]
    upper[labels[:, None] != batch.label[None, :]] = -np.inf
    if cells is not None:
        upper[cells[:, None] != batch.cell[None, :]] = -np.inf

    def scan(q, b):
        s = batch.scores(b, queries[q], longest)
        s[ids[q][:, None] == batch.ids[b][None, :]] = VB.NONE
        best.add(q, s, batch.ids[b])

    VB.expand(upper, lambda q, b: upper[q, b] >= best.floor[q], scan)
    return best


def _at_home(directions: np.ndarray, dim: int, every: int, k: int):
    """Each anchor (id divisible by ``every``) against the blocks of its label and direction that lie beside it."""
    schema = pa.schema([("id", pa.int64()), ("ints", pa.binary()), ("label", pa.int64()), ("floor", pa.int64())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            batch = VB.Batch(b, dim)
            own = [(block, i) for block, ids in enumerate(batch.ids) for i in np.flatnonzero((ids % every == 0) & (ids != VB.NO_ID))]
            if not own:
                continue
            ints, home = np.stack([batch.rows[block][i] for block, i in own]), np.array([block for block, _ in own])
            ids, labels = np.array([batch.ids[block][i] for block, i in own]), batch.label[home]
            best = _positives(batch, ints, ids, labels, np.full(len(ids), VB.NONE), directions, k, batch.cell[home])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([x.tobytes() for x in ints], pa.binary()), pa.array(labels), pa.array(best.score[:, -1])], schema=schema)

    return run


def _negatives(batch: VB.Batch, records: np.ndarray, directions: np.ndarray, k: int) -> VB.Best:
    """Best rows of other labels inside each window of each anchor; window j of anchor i is query i * windows + j."""
    windows = records["high"].shape[1]
    best, queries, high = VB.Best(records["floor"].reshape(-1), k), records["ints"].astype(np.float64), records["high"]
    longest = float(VB.norms(records["ints"]).max())
    lower, upper = score_intervals(batch, queries, directions)
    bounds = upper.copy()
    bounds[records["label"][:, None] == batch.label[None, :]] = -np.inf

    def overlaps(q, b):
        floor = best.floor.reshape(-1, windows)[q]
        return (upper[q, b][:, None] >= floor) & (lower[q, b][:, None] <= high[q]) & (floor <= high[q])

    def scan(q, b):
        s, asked = batch.scores(b, queries[q], longest), overlaps(q, b)
        for j in range(windows):
            at = np.flatnonzero(asked[:, j])
            if len(at):
                own = s[at]
                best.add(q[at] * windows + j, np.where(own <= high[q[at], j, None], own, VB.NONE), batch.ids[b])

    VB.expand(bounds, lambda q, b: overlaps(q, b).any(1), scan)
    return best


def windows_of(positives: DataFrame, slots: int, low: tuple[int, int], high: tuple[int, int]) -> DataFrame:
    """Per anchor (``query_id``) arrays of ``slots``: its positives, their scores and the bounds of their windows
    (scores from low[0]/low[1] to high[0]/high[1] of the positive's); unused and empty windows have floor > high."""
    up = lambda n, of: f"(score * {n} div {of} + IF(score * {n} % {of} > 0, 1, 0))"
    wide = "decimal(38,0)"
    p = positives.withColumn("score", F.col("score").cast(wide))
    p = p.selectExpr("query_id", "rank - 1 AS slot", "vec_id", "CAST(score AS long) AS score",
                     f"IF(score < 0, 1, CAST({up(*low)} AS long)) AS floor", f"IF(score < 0, 0, CAST(score * {high[0]} div {high[1]} AS long)) AS high")
    by_slot = p.groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("vec_id", "score", "floor", "high")))).alias("m"))
    every = F.sequence(F.lit(0), F.lit(slots - 1))
    take = lambda c, default: F.transform(every, lambda i: F.coalesce(F.col("m")[i][c], F.lit(default).cast("long"))).alias(c)
    return by_slot.select("query_id", take("vec_id", VB.NO_ID), take("score", 0), take("floor", 1), take("high", 0))


def mine(embeddings: DataFrame, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100), every: int = 50,
         scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", directions: int = DIRECTIONS,
         rounds: int | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors, rows whose id is
    divisible by ``every``. Scores are inner products of floor(scale * x); a negative's is from low to high (fractions) of its positive's."""
    spark = embeddings.sparkSession
    rows = written(spark, VB.clean(embeddings, vec_id, vector, scale, label), "negatives-rows")
    total, longest = rows.agg(F.count(F.lit(1)), F.max(F.octet_length("ints"))).first()
    dim = max(1, (longest or 0) // 4)
    at = fit_directions(VB.sample(rows, total, dim), directions)

    def keyed(x):
        a = angles(x, at)
        return a.argmin(1), a.min(1)

    blocks = VB.build(rows, dim, rounds or VB.rounds_of(total), keyed, lambda x: angle_range(x, at))
    home = map_arrow(blocks.df.drop("round"), _at_home(at, dim, every, positives), "id long, ints binary, label long, floor long")
    anchors = written(spark, home.groupBy("id").agg(F.min(F.struct("ints", "label", "floor")).alias("q")).select("id", "q.*"), "negatives-anchors")

    # positives: blocks of the anchor's label
    fields, hits, asking = [("label", 1), ("floor", 1)], None, anchors
    kind = VB.record(dim, fields)

    def same_label(batch, records):
        records = records[np.isin(records["label"], batch.label)]
        best = _positives(batch, records["ints"], records["id"], records["label"], records["floor"], at, positives)
        q, ids, score = best.rows()
        return records["id"][q], VB.named(ids), score

    for r in range(blocks.rounds):
        files = VB.write_queries(asking, dim, fields, ["label", "id"], "negatives-anchor-files")
        new = written(spark, VB.search(blocks.of_round(r), dim, files, kind, same_label, "query_id long, vec_id long, score long", _POSITIVE), "negatives-positives")
        hits = new if hits is None else hits.unionByName(new)
        if r + 1 < blocks.rounds:
            found = VB.kth(hits.withColumnRenamed("query_id", "id"), ["id"], positives)
            asking = written(spark, asking.join(found, "id", "left").withColumn("floor", F.greatest("floor", "found")).drop("found"), "negatives-anchors")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    wanted = windows_of(best, positives, low, high).withColumnRenamed("query_id", "id")
    asking = written(spark, anchors.select("id", "ints", "label").join(wanted, "id"), "negatives-windows")

    # negatives: blocks of other labels, inside the windows
    fields, hits = [("label", 1), *((c, positives) for c in ("vec_id", "score", "floor", "high"))], None
    wide = VB.record(dim, fields)

    def other_labels(batch, records):
        best = _negatives(batch, records, at, negatives)
        q, ids, score = best.rows()
        anchor, slot = q // positives, (q % positives).astype(np.int32)
        return records["id"][anchor], slot, VB.named(records["vec_id"][anchor, slot]), records["score"][anchor, slot], VB.named(ids), score

    schema = "anchor_id long, slot int, positive_id long, positive_score long, vec_id long, score long"
    for r in range(blocks.rounds):
        files = VB.write_queries(asking, dim, fields, ["label", "id"], "negatives-window-files")
        new = written(spark, VB.search(blocks.of_round(r), dim, files, wide, other_labels, schema, _NEGATIVE), "negatives-hits")
        hits = new if hits is None else hits.unionByName(new)
        if r + 1 < blocks.rounds:
            found = VB.kth(hits, ["anchor_id", "slot"], negatives).groupBy(F.col("anchor_id").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "found"))).alias("m"))
            floor = F.when(F.col("m").isNull(), F.col("floor")).otherwise(F.transform("floor", lambda f, i: F.greatest(f, F.try_element_at("m", i))))
            asking = written(spark, asking.join(found, "id", "left").withColumn("floor", floor).drop("m"), "negatives-windows")
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
