"""Language ID (operator 3): averaged hashed subword embeddings, linear softmax.

A text is the average of the embeddings of its hashed subwords: byte 3-grams and
4-grams of its words, word ends included, A-Z in lower case. A linear softmax over
the average gives the languages. Embeddings and softmax are trained together by
stochastic gradient descent in numpy, on random parts of the sample texts, so
that short texts are learnt as well. After training both factors fold into one
table (subword x language), and a text's scores are plain table sums.

The fit uses at most ``max_texts`` texts of each language, chosen by a hash of
their id. A part of the sample that is kept from training sets the temperature
of the softmax and, for ``language``, the score under which a text is rejected.

Defined cases: a null text or one without any letter is ``und`` with score 0;
without labelled texts everything is ``und``; a language with a single text is
learnt from that; rows without id are predicted and not learnt from; repeated
rows get equal results; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, sliced, written
from orderstream.llm.id_sets import id_number, keep_members, write_id_set
from orderstream.llm.words import U, buffers, mix

BUCKETS, DIMENSIONS = 1 << 16, 16
MAX_TEXTS = 500
SAMPLE_SUBWORDS, SAMPLE_PART = 20_000, 500  # of a sampled text, and of each of its parts
EPOCHS, RATE, PART = 6, 0.5, (8, 400)
RANK_PARTS = 16  # parts of a language that are ranked on their own first
CALIBRATION_SHARE = 5  # every fifth sample text isn't trained on
PRECISION = 0.99  # wanted among the texts that aren't rejected
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _b in range(97, 123):
    _FOLD[_b] = _FOLD[_b - 32] = _b
_SALTS = {3: U(0x9E3779B97F4A7C15), 4: U(0xC2B2AE3D27D4EB4F)}


def subwords(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, first of each text with the total), texts one after another in ``data``."""
    # a blank before and after each text closes its first and last word
    n = len(starts) - 1
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    begin = starts + 2 * np.arange(n + 1)
    lengths = np.diff(starts)
    place = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, lengths)
    padded[place] = _FOLD[data]
    blank = padded == 32
    wide = padded.astype(np.uint64)
    found, at = [], []
    for k in (3, 4):
        m = len(padded) - k + 1
        if m <= 0:
            continue
        keep = ~blank[1:m + 1]
        for j in range(2, k - 1):
            keep &= ~blank[j:m + j]
        keep &= ~(blank[:m] & blank[k - 1:m + k - 1] & (k == 3))  # a single letter alone tells little
        here = np.flatnonzero(keep)
        code = wide[here]
        for j in range(1, k):
            code = code << U(8) | wide[here + j]
        found.append((mix(code + _SALTS[k]) & U(BUCKETS - 1)).astype(np.int32))
        at.append(here)
    if not found:
        return np.empty(0, np.int32), np.zeros(n + 1, np.int64)
    # within a text first its 3-grams, then its 4-grams
    cuts = [np.searchsorted(a, begin) for a in at]
    total = sum(cuts)
    out = np.empty(total[-1], np.int32)
    offset = np.zeros(n, np.int64)
    for f, c in zip(found, cuts):
        size = np.diff(c)
        out[np.arange(len(f)) + np.repeat(total[:-1] + offset - c[:-1], size)] = f
        offset += size
    return out, total


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # subword x language
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = np.diff(starts)
        z = np.empty((len(n), len(self.languages)))
        some = np.flatnonzero(n)
        for k in range(len(self.languages)):
            z[:, k] = self.bias[k]
            if len(some):
                z[some, k] += np.add.reduceat(self.table[k][buckets], starts[some]) / n[some]
        z /= self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _sgd(texts: list[np.ndarray], y: np.ndarray, languages: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(table, bias) after training on random parts of the texts."""
    rng = np.random.default_rng(seed)
    e = rng.normal(scale=0.1, size=(BUCKETS, DIMENSIONS))
    w, b = rng.normal(scale=0.3, size=(DIMENSIONS, languages)), np.zeros(languages)
    share = np.bincount(y, minlength=languages)
    weight = (len(y) / (languages * np.maximum(share, 1)))[y]  # rare languages count as much
    steps, done = EPOCHS * len(texts), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(texts)):
            rate = RATE * (1 - done / steps) + 0.01
            done += 1
            t = texts[i]
            if not len(t):
                continue
            size = min(len(t), int(np.exp(rng.uniform(np.log(PART[0]), np.log(PART[1])))))
            first = rng.integers(0, len(t))
            part = np.take(t, np.arange(first, first + size), mode="wrap")
            x = e[part].mean(axis=0)
            z = x @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = rate * min(weight[i], 10.0) * p
            dx = w @ g
            w -= np.outer(x, g)
            b -= 0.1 * g
            np.subtract.at(e, part, dx[None, :] * (DIMENSIONS / size))
    return np.ascontiguousarray((e @ w).T), b


def spread(subwords: np.ndarray, most: int = SAMPLE_SUBWORDS, part: int = SAMPLE_PART) -> np.ndarray:
    """All of a text's subwords, or of a longer text parts of ``part`` from all over it, ``most`` together."""
    if len(subwords) <= most:
        return subwords
    starts = np.linspace(0, len(subwords) - part, most // part).astype(np.int64)
    return np.concatenate([subwords[i:i + part] for i in starts])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_texts: int = MAX_TEXTS, seed: int = 3) -> Model:
    """Learn from ``docs``; the caller leaves out what is held out. The sample is bounded: ``max_texts`` texts a
    language, and ``SAMPLE_SUBWORDS`` of a long text (parts from all over it), some 20 MB a language at most."""
    d = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"),
                    F.col(f"`{lang_col}`").cast("string").alias("lang")).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    # the smallest draws of each language, first within parts of it: a language that
    # holds most texts is ranked by many tasks, each of which passes on max_texts at most
    drawn = d.select("id", "lang", F.xxhash64("id", F.lit(seed)).alias("draw"), F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(RANK_PARTS)).alias("part"))
    for own in (("lang", "part"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*own).orderBy("draw", "id"))
        drawn = drawn.withColumn("place", place).where(F.col("place") <= max_texts)
    chosen = drawn.select("id", "lang").distinct()

    def take(batches):
        for batch in sliced(batches, "text", 1 << 20):
            b, at = subwords(*buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(
                [spread(b[at[i]:at[i + 1]]).astype(np.uint16).tobytes() for i in range(batch.num_rows)], pa.binary())], names=["id", "lang", "subwords"])

    # picked where they are read: a join would move every text to find these few
    chosen = written(docs.sparkSession, chosen, "language-sample")
    picked = keep_members(d.withColumn("number", id_number(F.col("id"), "string")), "number", write_id_set(chosen, "id", "language-ids")).drop("number")
    sample = map_arrow(picked.join(chosen, ["id", "lang"], "left_semi"), take, "id string, lang string, subwords binary")
    rows = sorted(sample.toLocalIterator(), key=lambda r: (r.lang, r.id))  # max_texts a language
    languages = sorted({r.lang for r in rows})
    if not languages:
        return Model([], np.empty((0, BUCKETS)), np.empty(0))
    texts = [np.frombuffer(r.subwords, np.uint16).astype(np.int32) for r in rows]
    y = np.array([languages.index(r.lang) for r in rows])
    aside = np.zeros(len(rows), bool)
    for k in range(len(languages)):
        aside[np.flatnonzero(y == k)[CALIBRATION_SHARE - 1::CALIBRATION_SHARE]] = True
    model = Model(languages, *_sgd([t for t, a in zip(texts, aside) if not a], y[~aside], len(languages), seed))
    held = [t for t, a in zip(texts, aside) if a]
    if held:
        joined, starts = np.concatenate(held), np.concatenate([[0], np.cumsum([len(t) for t in held])])
        truth = y[aside]

        def loss(temperature):
            model.temperature = temperature
            return -np.log(model.probabilities(joined, starts)[np.arange(len(truth)), truth] + 1e-12).mean()

        model.temperature = min(np.geomspace(0.1, 10, 41), key=loss)
        p = model.probabilities(joined, starts)
        best, right = p.max(axis=1), p.argmax(axis=1) == truth
        order = np.argsort(-best)
        precise = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= PRECISION)
        model.reject_below = float(best[order[precise[-1]]]) if len(precise) else 1.0
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, language): the likeliest language and its
    probability; ``language`` is ``und`` as well where the score is rejected."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            clear = batch.set_column(1, "text", batch.column("text").fill_null(""))
            for part in sliced(iter([clear]), "text", 1 << 20):
                letters = np.array([has_letter(t) for t in part.column("text").to_pylist()])
                if not model.languages:
                    name, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                    sure = name
                else:
                    p = model.probabilities(*subwords(*buffers(part.column("text"))))
                    score = np.where(letters, p.max(axis=1), 0.0)
                    name = [model.languages[k] if ok else UNKNOWN for k, ok in zip(p.argmax(axis=1), letters)]
                    sure = [x if s >= model.reject_below else UNKNOWN for x, s in zip(name, score)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(name, pa.string()), pa.array(score), pa.array(sure, pa.string())],
                                                 names=["id", "lang_pred", "score", "language"])

    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_arrow(d, run, f"id {key}, lang_pred string, score double, language string").withColumnRenamed("id", id_col)
