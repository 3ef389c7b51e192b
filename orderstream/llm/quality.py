"""Quality classifier (operator 1): random Fourier features, ridge, isotonic calibration.

A document becomes a short vector of statistics of its whole text. Random Fourier
features of the standardised vector approximate a Gaussian kernel; ridge
regression on them is fitted from normal equations, whose rows are summed
partition by partition and then over partitions. Scores of a set-aside part of
the training rows are pooled by adjacent violators into a rising step curve,
from which every score is calibrated.

The fit uses at most ``max_rows`` labelled rows (a hash of the id decides which,
so the choice is the same at any partitioning); statistics, scores and decisions
cover all documents. Held-out rows are never seen by a fit.

Defined cases: a null text counts as empty and empty texts are scored like any
other, from zero statistics; several labels of a document all count, null
labels and labels of unknown documents don't; without usable labels every score
is 0.5; a document without id is scored and never learnt from; repeated rows get
equal scores; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import fold, map_arrow, sliced, text_or_empty, unused, written
from orderstream.llm.id_sets import id_number, keep_members, write_id_set

HOLD_OUT_FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
MAX_ROWS = 100_000
FEATURES = 256
WIDTH = 2.0
RIDGE = 1e-3
ACCEPT = 0.3
BINS = 4096
SUM_PARTITIONS = 16
PIECE = 4 << 20

#: Byte classes that are counted: each byte falls in one.
CLASSES = ["lower", "upper", "digit", "blank", "line", "stop", "bang", "bar", "sign", "beyond", "control"]


def _class_table() -> np.ndarray:
    def kind(b: int) -> str:
        c = chr(b)
        if b >= 128:
            return "beyond"
        if c.isalpha():
            return "lower" if c.islower() else "upper"
        if c.isdigit():
            return "digit"
        return {" ": "blank", "\t": "blank", "\n": "line", "\r": "line", "!": "bang", "|": "bar"}.get(
            c, "stop" if c in ".,;:?'\"()-" else "sign" if 32 < b < 127 else "control")
    return np.array([CLASSES.index(kind(b)) for b in range(256)], np.uint8)


CLASS_OF = _class_table()
STATISTICS = len(CLASSES) + 10


def _text_pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        cut = text.find(b"\n", at + PIECE)
        cut = text.find(b" ", at + PIECE) if cut < 0 or cut > at + 2 * PIECE else cut
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def statistics(text: bytes) -> list[float]:
    """Shares of byte classes, word and line statistics; zeros for an empty text."""
    if not text:
        return [0.0] * STATISTICS
    counts = np.zeros(len(CLASSES))
    words, lines = Counter(), Counter()
    n_words = n_lines = same = bare = 0
    for part in _text_pieces(text):
        counts += np.bincount(CLASS_OF[np.frombuffer(part, np.uint8)], minlength=len(CLASSES))
        w = part.split()
        words.update(w)
        n_words += len(w)
        same += sum(map(eq, w, w[1:]))
        own = [x for x in part.split(b"\n") if x]
        lines.update(own)
        n_lines += len(own)
    n = len(text)
    w = max(n_words, 1)
    bare = sum(c for x, c in words.items() if not x.isalnum() and x.isascii())
    top = max(words.values(), default=0)
    return [*np.sqrt(counts / n).tolist(), np.log1p(n) / 10, np.log1p(n_words) / 10, n / w / 10, len(words) / w, top / w, same / w,
            bare / w, min(n_lines / w, 1.0), 1 - len(lines) / max(n_lines, 1), np.log1p(w / max(n_lines, 1)) / 5]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, f): the statistics of every row."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            f = [statistics(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(f, pa.list_(pa.float64()))], names=["id", "f"])

    d = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    return map_arrow(d, run, f"id {key}, f array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    beta: np.ndarray
    knots: np.ndarray | None = None  # raw scores, rising
    levels: np.ndarray | None = None  # calibrated scores at the knots

    def features(self, f: np.ndarray) -> np.ndarray:
        z = np.clip((f - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases), np.ones((len(f), 1))])

    def raw(self, f: np.ndarray) -> np.ndarray:
        return self.features(f) @ self.beta

    def scores(self, f: np.ndarray) -> np.ndarray:
        if not len(self.beta):
            return np.full(len(f), 0.5)
        raw = self.raw(f)
        if self.knots is None:
            return np.clip(raw, 0, 1)
        # the curve is flat within a pool: a little of the raw score keeps the order
        return np.clip(0.999 * np.interp(raw, self.knots, self.levels) + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def pool_adjacent_violators(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The rising sequence with the least weighted squared distance from ``y``."""
    level, weight, size = [], [], []
    for yi, wi in zip(y, w):
        level.append(yi)
        weight.append(wi)
        size.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            total = weight[-2] + weight[-1]
            level[-2] = (level[-2] * weight[-2] + level[-1] * weight[-1]) / total
            weight[-2] = total
            size[-2] += size[-1]
            del level[-1], weight[-1], size[-1]
    return np.repeat(level, size)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATISTICS)


def _normal_rows(model: Model):
    """Each partition's sum of the normal equations, a row of them to a record."""
    def run(batches):
        width = len(model.phases) + 1
        total = np.zeros((width, width + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.features(_matrix(batch.column("f")))
                total += z.T @ np.hstack([z, batch.column("y").to_numpy(zero_copy_only=False)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["r", "v"])
    return run


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"r": pdf["r"].iloc[:1], "v": [np.sum(np.stack(pdf["v"].to_list()), axis=0)]})


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_rows: int = MAX_ROWS,
        seed: int = 7) -> Model:
    """Learn from the rows of ``stats`` (id, f) that have a label and aren't held out."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    part = fold(F.col("id"), HOLD_OUT_FOLDS)
    rows = known.withColumn("part", part).where(F.col("part") != HELD_OUT)
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * max_rows / n))
    train = written(stats.sparkSession, rows.join(stats, "id").repartition(SUM_PARTITIONS, "id"), "quality-train")
    fitted = train.where(F.col("part") != CALIBRATION)
    sums = fitted.agg(F.count(F.lit(1)).alias("n"), *[g(F.col("f")[i]).alias(f"{a}{i}") for i in range(STATISTICS)
                                                      for a, g in (("m", F.avg), ("s", F.stddev_pop))]).first()
    nothing = np.empty(0)
    if not sums["n"]:
        return Model(nothing, nothing, nothing, nothing, nothing)
    rng = np.random.default_rng(seed)
    model = Model(np.array([sums[f"m{i}"] for i in range(STATISTICS)]), np.array([max(sums[f"s{i}"], 1e-3) for i in range(STATISTICS)]),
                  rng.normal(size=(STATISTICS, FEATURES)) / (WIDTH * np.sqrt(STATISTICS)), rng.uniform(0, 2 * np.pi, FEATURES), nothing)
    added = (map_arrow(fitted.select("f", "y"), _normal_rows(model), "r int, v array<double>")
             .groupBy("r").applyInPandas(_add_up, "r int, v array<double>").collect())
    normal = np.array([r.v for r in sorted(added, key=lambda r: r.r)])
    penalty = RIDGE * sums["n"] * np.eye(FEATURES + 1) / FEATURES
    penalty[-1, -1] = 0.0
    model.beta = np.linalg.solve(normal[:, :-1] + penalty, normal[:, -1])

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                b = np.clip((model.raw(_matrix(batch.column("f"))) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(b), batch.column("y")], names=["bin", "y"])

    curve = (train.where(F.col("part") == CALIBRATION).select("f", "y").mapInArrow(binned, "bin int, y double")
             .groupBy("bin").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).collect())  # BINS rows at most
    if curve:
        curve.sort(key=lambda r: r.bin)
        y, w = np.array([r.y for r in curve]), np.array([float(r.n) for r in curve])
        model.levels = np.clip(pool_adjacent_violators(y / w, w), 0.0, 1.0)
        model.knots = (np.array([r.bin for r in curve]) + 0.5) / BINS * 2 - 0.5
    return model


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """The documents that ``fit`` can learn from, picked where they are read: those with a label that aren't held out."""
    known = labels.where(F.col(f"`{label_col}`").isNotNull() & (fold(F.col(f"`{id_col}`"), HOLD_OUT_FOLDS) != HELD_OUT))
    number, kind = unused(docs.columns, "number"), docs.schema[id_col].dataType.simpleString()
    ids = known.select(F.col(f"`{id_col}`").cast(kind).alias("id"))
    return keep_members(docs.withColumn(number, id_number(F.col(f"`{id_col}`"), kind)), number, write_id_set(ids, "id", "quality-labelled")).drop(number)


def score(stats: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id, score) for every row of ``stats``."""
    key = stats.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.scores(_matrix(batch.column("f"))))], names=["id", "score"])

    return map_arrow(stats.select("id", "f"), run, f"id {key}, score double").withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, model: Model, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The documents whose score reaches ``accept``, all their columns as they were."""
    def run(batches):
        for batch in sliced(batches, text_col):
            f = np.array([statistics((t.as_py() or "").encode()) for t in batch.column(text_col)])
            yield batch.filter(pa.array(model.scores(f) >= accept))

    return map_arrow(docs, run, docs.schema)
