"""Operators 11 and 12 against brute force, their bounds, and their defined cases."""

import math
import random

import numpy as np
import pytest

from orderstream.llm import hard_negatives, pivot_search
from orderstream.llm import vector_blocks as VB

SCHEMA = "vec_id long, embedding array<float>, label int, id long, ints string, rank int, score string, LOW int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2, "y", 3) for i, v, label in rows], SCHEMA)


def taken(rows, scale, labelled):
    """(id, integers, label) of rows that take part; components are single precision in the table."""
    out = []
    for i, v, label in rows:
        if v is None or any(x is None or not math.isfinite(np.float32(x)) for x in v) or labelled and label is None:
            continue
        ints = [math.floor(float(np.float32(x)) * scale) for x in v]
        if all(abs(x) < 2**31 for x in ints) and sum(x * x for x in ints) < 2**62:
            out.append((i, ints, label))
    return out


def asking(rows, every):
    """Of query rows with one id the one whose bytes sort first."""
    best = {}
    for i, v, label in rows:
        if i is not None and i % every == 0:
            key = (np.array(v, "<i4").tobytes(), label)
            if i not in best or key < best[i][0]:
                best[i] = key, v, label
    return [(i, v, label) for i, (_, v, label) in sorted(best.items())]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def by_score(pair):
    score, i = pair[:2]
    return -score, i is None, i or 0


def brute_top(rows, k, every, scale):
    rows = taken(rows, scale, False)
    out = []
    for q, v, _ in asking(rows, every):
        best = sorted(((dot(v, w), i) for i, w, _ in rows if i != q), key=by_score)[:k]
        out += [(q, r, i, s) for r, (s, i) in enumerate(best, 1)]
    return out


def brute_negatives(rows, every, positives, negatives, scale):
    rows = taken(rows, scale, True)
    out = []
    for a, v, label in asking(rows, every):
        scored = [(dot(v, w), i, own) for i, w, own in rows]
        for ps, p, _ in sorted((x for x in scored if x[2] == label and x[1] != a), key=by_score)[:positives]:
            inside = sorted((x for x in scored if x[2] != label and 50 * ps <= 100 * x[0] <= 95 * ps), key=by_score)[:negatives]
            out += [(a, p, r, i, ps, s) for r, (s, i, _) in enumerate(inside, 1)]
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clustered(n, dim, seed=3):
    """Rows round a few centres, with copies, zeros, small whole components (ties), long vectors and cases to leave out."""
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        m, spread = rng.choice(middles), rng.choice([0.05, 0.3, 1.0])
        v = [x + rng.gauss(0, spread) for x in m]
        if i % 9 == 0:
            v = [float(rng.randint(-1, 1)) for _ in range(dim)]
        if i % 31 == 0:
            v = [100 * x for x in v]
        rows.append((i, v, rng.choice([0, 0, 0, 1, 2])))
    rows += [(n + i, middles[0], i % 2) for i in range(n // 3)]  # a third holds one vector
    rows += [(None, middles[1], 1), (None, None, 1), (7, None, 0), (20, [], 1), (None, [0.0] * dim, 0), (-10, middles[2][:3], 0), (-11, [*middles[2], 5.0], 1),
             (10, middles[3], 2), (10, middles[3], 2), (10, middles[4], 0), (33, [float("nan")] * dim, 0), (40, [float("inf")] + [0.0] * (dim - 1), 1),
             (50, [None, *middles[0][1:]], 1), (60, middles[2], None), (70, [1e30] * dim, 1)]
    return rows


@pytest.mark.parametrize(("rounds", "size", "dim"), [(None, 256, 5), (3, 8, 5), (2, 16, 24)])
def test_against_brute_force(spark, monkeypatch, rounds, size, dim):
    monkeypatch.setattr(VB, "BLOCK_ROWS", size)
    monkeypatch.setattr(VB, "FILE_QUERIES", 7)
    rows = clustered(300, dim)
    df = frame(spark, rows).repartition(4)
    assert rows_of(pivot_search.top_k(df, k=4, every=10, rounds=rounds, pivots=8)) == sorted(brute_top(rows, 4, 10, 1024), key=repr)
    got = rows_of(hard_negatives.mine(df, every=10, rounds=rounds, directions=6))
    assert got and got == sorted(brute_negatives(rows, 10, 5, 3, 256), key=repr)


def test_scores_beyond_doubles(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-2**20, 2**20)) for _ in range(4)], i % 2) for i in range(80)]
    df = frame(spark, rows)
    assert rows_of(pivot_search.top_k(df, k=3, every=8)) == sorted(brute_top(rows, 3, 8, 1024), key=repr)
    assert rows_of(hard_negatives.mine(df, every=8, low=(50, 100), scale=1024)) == sorted(brute_negatives(rows, 8, 5, 3, 1024), key=repr)


def test_nothing_to_find(spark):
    none = frame(spark, [(1, [1.0], 1)]).where("false")
    assert pivot_search.top_k(none).columns == ["query_id", "rank", "vec_id", "score"] and pivot_search.top_k(none).count() == 0
    assert hard_negatives.mine(none).count() == 0
    alone = frame(spark, [(100, [1.0, 2.0], 1)])
    assert pivot_search.top_k(alone).count() == 0 and hard_negatives.mine(alone).count() == 0
    unasked = frame(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)])
    assert pivot_search.top_k(unasked).count() == 0 and hard_negatives.mine(unasked).count() == 0


def batch_of(rows, size, hull=None, low=None, high=None):
    import pyarrow as pa

    parts = [rows[i:i + size] for i in range(0, len(rows), size)]
    lengths = [VB.norms(p) for p in parts]
    values = [[0] * len(parts), [0] * len(parts), low or [0.0] * len(parts), high or [0.0] * len(parts), [len(p) for p in parts], [float(x.min()) for x in lengths],
              [float(x.max()) for x in lengths], [0] * len(parts), [np.arange(len(p)).tobytes() for p in parts], [p.astype("<i4").tobytes() for p in parts],
              [hull(p) if hull else None for p in parts]]
    return VB.Batch(pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, VB._BLOCK_ARROW.types, strict=True)], schema=VB._BLOCK_ARROW), rows.shape[1])


@pytest.mark.parametrize("spread", [3, 400, 10**6])
def test_bounds_hold_and_prune(spread):
    rng = np.random.default_rng(spread)
    middles = rng.integers(-spread, spread, (5, 8))
    rows = np.concatenate([m + rng.integers(-spread // 3, spread // 3 + 1, (64, 8)) for m in middles]).astype(np.int64)
    asked = np.concatenate([rows[::17], rng.integers(-spread, spread, (20, 8)), np.zeros((1, 8), np.int64)])
    exact = asked @ rows.T

    directions = hard_negatives.fit_directions(rows, 5)
    batch = batch_of(rows, 16, lambda x: hard_negatives.angle_range(x, directions))
    low, high = hard_negatives.score_intervals(batch, asked.astype(float), directions)
    for b in range(len(batch)):
        own = exact[:, 16 * b:16 * b + 16]
        assert (own <= high[:, b, None]).all() and (own >= low[:, b, None]).all()

    pivots = pivot_search.fit_pivots(rows, 1)
    away = VB.norms(rows - pivots[0])
    rows = rows[np.argsort(away)]
    exact, away = asked @ rows.T, np.sort(away)
    batch = batch_of(rows, 16, None, [float(away[i]) for i in range(0, len(rows), 16)], [float(away[i + 15]) for i in range(0, len(rows), 16)])
    bounds = pivot_search.annulus_bounds(batch, asked.astype(float), pivots)
    for b in range(len(batch)):
        assert (exact[:, 16 * b:16 * b + 16] <= bounds[:, b, None]).all()


def test_tight_clusters_are_skipped():
    """Where vectors lie in clusters, most blocks are never scored."""
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 1000, (16, 8))
    rows = np.concatenate([m + rng.normal(0, 20, (128, 8)) for m in middles]).astype(np.int64)
    directions = hard_negatives.fit_directions(rows, 16)
    batch = batch_of(rows, 32, lambda x: hard_negatives.angle_range(x, directions))
    asked = rows[::100].astype(float)
    best, upper = VB.Best(np.full(len(asked), VB.NONE), 5), hard_negatives.score_intervals(batch, asked, directions)[1]
    scanned, possible = VB.expand(upper, lambda q, b: upper[q, b] >= best.floor[q], lambda q, b: best.add(q, batch.scores(b, asked[q], 1e4), batch.ids[b]))
    assert scanned < possible / 4
    want = np.sort(asked.astype(np.int64) @ rows.T, 1)[:, -5:][:, ::-1]
    assert (best.score == want).all()


def test_rounds_grow():
    assert [VB.rounds_of(n) for n in (0, 1 << 16, (1 << 16) + 1, 1 << 20, (1 << 20) + 16)] == [1, 1, 2, 2, 3]
