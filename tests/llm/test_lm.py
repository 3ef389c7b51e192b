"""Operator 5 against a dictionary-based Kneser-Ney model, and its defined cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderstream.llm import lm, lm_triples, queries

SF001 = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), "</s>"]


class Brute:
    """Counts by dictionaries: raw at the highest order, numbers of different words before below."""

    def __init__(self, texts, order=3):
        self.order, self.uni, top = order, Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.uni.update(w)
            padded = ["<s>"] * (order - 1) + w
            top.update(tuple(padded[i:i + order]) for i in range(len(w)))
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.total, self.kinds, self.d = Counter(), defaultdict(Counter), {}
        for k, counts in self.counts.items():
            self.d[k] = lm._discounts([sum(c == j for c in counts.values()) for j in (1, 2, 3, 4)])
            for g, c in counts.items():
                self.total[g[:-1]] += c
                self.kinds[g[:-1]][min(c, 3)] += 1

    def p(self, *gram):
        if not gram:
            return 1 / (self.v + 1)
        low, context = self.p(*gram[1:]), gram[:-1]
        if not self.total[context]:
            return low
        d, c = self.d[len(gram)], self.counts[len(gram)][gram]
        spare = sum(d[j] * self.kinds[context][j] for j in (1, 2, 3))
        return (c - d[min(c, 3)] + spare * low) / self.total[context]

    def score(self, text):
        w = tokens(text)
        base = sum(math.log10((self.uni[x] + 1) / (self.n + self.v + 1)) for x in w)
        padded = ["<s>"] * (self.order - 1) + w
        log = sum(math.log10(self.p(*padded[i:i + self.order])) for i in range(len(w)))
        return len(w), sum(self.uni[x] > 0 for x in w), self.n, base, log


def compare(rows, texts, brute):
    assert sorted(i for i, *_ in rows) == sorted(i for i, _ in texts)
    of = dict(texts)
    for i, *got in rows:
        assert got == pytest.approx(brute.score(of[i]), rel=1e-9), of[i][:50]


def test_probabilities_add_up_to_one():
    rnd = random.Random(0)
    b = Brute([" ".join(f"w{min(rnd.randint(0, 30), rnd.randint(0, 30))}" for _ in range(50)) for _ in range(40)])
    for context in (("<s>", "<s>"), ("<s>", "w1"), ("w2", "w1"), ("never", "w1"), ("w1", "never")):
        assert sum(b.p(*context, x) for x in [*b.uni, "unknown"]) == pytest.approx(1)


@pytest.mark.parametrize("order, flush", [(2, 40), (3, lm.FLUSH_TOKENS), (3, 40)])
def test_scores_equal_brute_force(spark, order, flush):
    rnd = random.Random(3)
    word = lambda: rnd.choice(["the", "The", "é", "a|b", "9"]) if rnd.random() < 0.5 else f"w{int(rnd.expovariate(0.02))}"
    texts = [(i, rnd.choice([" ", "\n", "\t\x0b "]).join(word() for _ in range(rnd.randint(0, 80)))) for i in range(120)]
    texts += [(200, ""), (201, "  \n"), (202, "never seen words é"), (203, "the " * 5000)]
    df = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, score string")
    model = lm.train(df.where("doc_id % 3 <> 0"), flush_tokens=flush, block_bits=5, order=order)
    got = lm.score(df, model).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    compare([tuple(r) for r in got], texts, Brute([t for i, t in texts if i % 3], order))


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    brute = Brute([t for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2])
    got = queries.op5_language_model(spark, SF001).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    compare([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], docs, brute)


def test_null_and_no_training_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "a b"), (None, "a"), (2, "a b")], "doc_id long, text string")
    none = lm.train(df.where("false"))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.score, r.base_score) for r in lm.score(df, none).collect()), key=repr)
    assert got == sorted([(1, 1, 0, 0.0, 0.0), (2, 3, 0, 0.0, 0.0), (2, 3, 0, 0.0, 0.0), (None, 2, 0, 0.0, 0.0)], key=repr)
    one = lm.train(df)
    assert lm.score(df.where("false"), one).count() == 0
    assert all(math.isfinite(r.score) and r.train_tokens == 9 for r in lm.score(df, one).collect())


def test_triples_packed_and_searched(tmp_path):
    rnd = random.Random(8)
    grams = [(min(rnd.randint(0, 6), rnd.randint(0, 6)), rnd.randint(0, 2), rnd.randint(0, 400)) for _ in range(3000)]
    middle, left, third = (np.array(x, np.uint32) for x in zip(*grams))
    context, starts, thirds, counts = lm_triples.counted(middle, left, third, None)
    records = list(lm_triples.packed(context, starts, thirds, counts, (context >> np.uint64(32)).astype(np.int64) % 2))
    assert [s for s, *_ in records] == [0, 1]
    want = Counter(grams)
    for s, keys, packed in records:
        parts = lm_triples.unpacked(keys, packed)
        assert {tuple(map(int, g)): int(c) for *g, c in zip(*parts)} == {g: c for g, c in want.items() if g[0] % 2 == s}
        lm_triples.write_triples(str(tmp_path), s, *lm_triples.counted(*(np.concatenate([x, x]) for x in parts)))
        asked = [(m, x, t) for m in range(s, 9, 2) for x in range(4) for t in [*range(0, 405, 3), -1]]
        got, sums = lm_triples.triple_counts(str(tmp_path), s, *(np.array(x, np.int64) for x in zip(*asked)))
        assert got.tolist() == [2 * want[g] for g in asked]
        followers = defaultdict(list)
        for (m, x, _), c in want.items():
            followers[m, x].append(2 * c)
        assert max(map(len, followers.values())) > lm_triples.LONG > min(map(len, followers.values()))
        of = {k: [sum(v), 0, sum(c == 2 for c in v), sum(c > 2 for c in v)] for k, v in followers.items()}
        assert sums.tolist() == [of.get((m, x), [0] * 4) for m, x, _ in asked]
    assert lm_triples.triple_counts(str(tmp_path), 7, *np.zeros((3, 2), np.int64))[0].tolist() == [0, 0]
