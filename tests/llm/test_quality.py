"""Operator 1: held-out accuracy, its parts, and the defined cases."""

import zlib

import numpy as np
import pytest

from orderstream.llm import quality, queries
from orderstream.llm.common import read_table

SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


def test_pool_adjacent_violators_is_the_best_rising_curve():
    rng = np.random.default_rng(2)
    for _ in range(50):
        y, w = rng.random(8), rng.integers(1, 5, 8).astype(float)
        got = quality.pool_adjacent_violators(y, w)
        assert (np.diff(got) >= -1e-12).all()
        # min-max formula of isotonic regression
        want = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(i, 8)) for a in range(i + 1)) for i in range(8)]
        assert got == pytest.approx(want)


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(0)
    k, n = quality.STATISTICS, 4000
    m = quality.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, n)) / (quality.WIDTH * np.sqrt(k)), rng.uniform(0, 2 * np.pi, n), np.empty(0))
    x = rng.normal(size=(6, k))
    z = m.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.WIDTH ** 2 * k))
    assert np.abs(z @ z.T - exact).max() < 0.08


def test_statistics_don_t_depend_on_pieces(monkeypatch):
    text = ("Some words, here! | 12 \n" * 40 + "\n\nwords words words\nend").encode()
    whole = quality.statistics(text)
    assert quality.statistics(b"") == [0.0] * quality.STATISTICS and len(whole) == quality.STATISTICS
    monkeypatch.setattr(quality, "PIECE", 60)
    parts = quality.statistics(text)
    assert parts[:len(quality.CLASSES)] == pytest.approx(whole[:len(quality.CLASSES)])


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op1_quality(spark, SF1).collect()}
    docs = read_table(spark, SF1, "documents")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
               for i, r in got.items())
    test = [(r.quality, got[r.doc_id]) for r in read_table(spark, SF1, "labels").collect() if got[r.doc_id].held_out]
    assert len(test) > 500
    assert np.mean([y == r.predicted for y, r in test]) > 0.97
    good, bad = [r.score for y, r in test if y], [r.score for y, r in test if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word " * 300_000, None), (None, "a b", "z"), (3, "word " * 300_000, None)],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (99, 1), (None, 0)], "doc_id long, quality int")
    stats = quality.document_statistics(docs)
    for lab in (labels, labels.where("false")):
        m = quality.fit(stats, lab)
        s = [(r.doc_id, r.score) for r in quality.score(stats, m).collect()]
        assert len(s) == 5 and all(0 <= x <= 1 for _, x in s)
        assert len({x for i, x in s if i == 3}) == 1
        kept = quality.keep_accepted(docs, m)
        assert kept.columns == docs.columns
        kept.collect()
    assert quality.score(stats.where("false"), m).count() == 0
