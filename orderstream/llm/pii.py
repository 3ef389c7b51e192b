"""PII (operator 2): candidate gradient boosting.

The base patterns (e-mail addresses, IP addresses, payment cards, phone numbers) always
count. Generators of high recall propose further spans: written-out or defanged
addresses, cards and phone numbers with other separators or prefixes. Spans may
overlap. Boosted trees judge a candidate by its format and the words around it,
probabilities are calibrated, and a threshold for each kind, set on rows kept
from training, selects the redactions that are added.

Labels come from the documents themselves: the base matches of every text,
rewritten in the ways the generators look for, are the positives; the same
rewritings of broken values (failing checksums, parts over 255, wrong lengths) and the
texts' own candidates that no check supports are the negatives. Bins, trees, calibration and
thresholds come from all of them: sums over the rows are taken by Spark, and only sums of a
bounded number of cells come to the driver. Without any base match nothing is learnt and nothing is added.

Defined cases: a null text counts as empty and has no spans; positions are code
points, ends exclusive; a candidate that overlaps a base span is dropped, of
candidates that overlap each other the likeliest stays (ties: the earlier kind,
then the earlier span); texts are searched whole at any length, in time linear
in it; repeated rows get equal results; other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
PRECISION = 0.995
#: Training rows kept for calibration and thresholds. After so many trees the rows' margins are written anew.
ASIDE, REFRESH = 0.25, 15
#: Cells of a unit of the margin in which calibration and thresholds count rows.
CELLS = 1024
#: Up to so many tasks a pass's sums, some 70 KB of each task, go to the driver at once.
FEW_TASKS = 64

# Base patterns: the asked-for expressions, with the starts that can't match left out
# (a run's later starts fail where its first one does), so that searching is linear.
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def _small_part(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) <= 3 and int(p or "0") <= 255


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """For each kind the base matches (start, end), leftmost and non-overlapping."""
    email, ip, card, phone = [], [], [], []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            email.append((start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)
    if _DIGIT.search(text):
        ip = [m.span() for m in _IP.finditer(text) if all(map(_small_part, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = only_digits(m.group())
                if 16 <= len(d) <= 19 and luhn(d):
                    card.append(m.span())
        if "+" in text:
            phone = [m.span() for m in _PHONE.finditer(text) if 8 <= len(only_digits(m.group())) <= 15]
    return [email, ip, card, phone]


# ---- candidates ----------------------------------------------------------------

_AT = r"(?:\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?|\x20(?:at|AT)\x20|\x20?@\x20?)"
_DOT = r"(?:\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?|\x20(?:dot|DOT)\x20|\.)"
_WRITTEN_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}")
_WRITTEN_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\x20?\[\.\]\x20?|\x20?\(\.\)\x20?|\x20dot\x20|\[dot\]|\x20\.\x20)[0-9]{1,3}){3}(?![0-9])")
_DIGITS = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20()./\\_\xa0:-]{0,2}[0-9]){6,24}(?![0-9A-Za-z])")
#: Words that often stand before a value of each kind.
HINTS = {
    "email": ("mail", "contact", "write", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "addr", "login"),
    "card": ("card", "visa", "credit", "master", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "cell"),
}
_AROUND = 24


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of every proposal; they may overlap and repeat base spans."""
    for m in _WRITTEN_EMAIL.finditer(text):
        yield 0, *m.span()
    if _DIGIT.search(text):
        if "[" in text or "(." in text or "dot" in text or " . " in text:
            for m in _WRITTEN_IP.finditer(text):
                yield 1, *m.span()
        for m in _DIGITS.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            if 12 <= n <= 20:
                yield 2, *m.span()
            if n <= 16:
                yield 3, *m.span()


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span = text[start:end]
    digits = only_digits(span)
    runs = re.findall("[0-9]+", span)
    parts = [int(r) for r in runs if len(r) <= 9]
    before, after = text[max(0, start - _AROUND):start].lower(), text[end:end + _AROUND].lower()
    tail = re.search("[A-Za-z]+$", span)
    hints = [float(any(h in before for h in HINTS[k])) for k in KINDS]
    return [
        *[float(kind == k) for k in range(4)], len(span), len(digits), len(runs), float(max(map(len, runs), default=0)),
        float(min(map(len, runs), default=0)), float(bool(digits) and luhn(digits)), float(max(parts, default=-1)),
        float(len(digits) in (13, 14, 15, 16, 19)), float(span[:1] == "+"), float(span[:1] == "(" or ") " in span), span.count(" "), span.count("-"),
        span.count("."), span.count("/") + span.count(":") + span.count("_"), float("@" in span), float(" at " in span.lower()),
        float("[" in span or "(" in span or "{" in span), float("dot" in span.lower()), float(len(tail.group()) if tail else 0),
        float(len(set(map(len, runs))) == 1), float(runs[0] in ("4", "5", "00", "0") if runs else 0),
        float(digits[:1] in "3456" if digits else 0), *hints, float(hints[kind]),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before.rstrip()[-1:] in ("=", "#", ":")), float("%" in after[:2] or "." in after[:1] and after[1:2].isdigit()),
    ]


# ---- boosted trees ---------------------------------------------------------------

@dataclass
class Trees:
    """Trees of a fixed depth on binned features: at level l node i looks at feature
    f[l][i]; rows beyond the cut go right."""
    edges: list[np.ndarray] = field(default_factory=list)
    splits: list[list[tuple[np.ndarray, np.ndarray]]] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.add(self.binned(x), np.full(len(x), self.start))

    def add(self, b: np.ndarray, out: np.ndarray, since: int = 0) -> np.ndarray:
        """``out`` with the leaves added that the binned rows reach in the trees from ``since`` on."""
        for split, leaf in zip(self.splits[since:], self.leaves[since:]):
            out += leaf[_nodes(b, split)]
        return out


def _nodes(b: np.ndarray, split: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    node = np.zeros(len(b), np.int64)
    for f, cut in split:
        node = node * 2 + (b[np.arange(len(b)), f[node]] > cut[node])
    return node


def _sums(b: np.ndarray, y: np.ndarray, f: np.ndarray, split: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """The sums of gradients and of curvatures by node, feature and bin, of rows with margins ``f``."""
    p = 1 / (1 + np.exp(-f))
    node, n = _nodes(b, split), 1 << len(split)
    out = np.zeros((2, n, b.shape[1], width))
    for j in range(b.shape[1]):
        key = node * width + b[:, j]
        for k, v in enumerate((y - p, p * (1 - p))):
            out[k, :, j] = np.bincount(key, v, n * width).reshape(n, width)
    return out


def _best(sums: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut) of each node's best split, and the sums of the nodes below, in pairs."""
    _, n, features, width = sums.shape
    gs, hs = sums.cumsum(axis=3)
    best, feature, cut = np.zeros(n), np.zeros(n, np.int64), np.full(n, width)
    for j in range(features):
        g, h, gt, ht = gs[:, j], hs[:, j], gs[:, j, -1:], hs[:, j, -1:]
        gain = g ** 2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt ** 2 / (ht + ridge)
        at = gain.argmax(axis=1)
        top = gain[np.arange(n), at]
        better = top > best + 1e-9
        best[better], feature[better], cut[better] = top[better], j, at[better]
    left = np.stack([v[np.arange(n), feature, np.minimum(cut, width - 1)] for v in (gs, hs)])
    below = np.stack([left, np.stack([gs[:, 0, -1], hs[:, 0, -1]]) - left], axis=2)
    return feature, cut, below.reshape(2, 2 * n)


def _grow(model: Trees, mean: float, sums: Callable[[list, int], np.ndarray], trees: int, depth: int, rate: float, ridge: float) -> Trees:
    """Gradient boosting on the logistic loss with second-order leaves. ``sums(split, width)`` are those of all
    rows with the margins that the model gives so far."""
    width = max(len(e) for e in model.edges) + 1
    mean = np.clip(mean, 1e-3, 1 - 1e-3)
    model.start = float(np.log(mean / (1 - mean)))
    for _ in range(trees):
        split = []
        for _ in range(depth):
            feature, cut, (g, h) = _best(sums(split, width), ridge)
            split.append((feature, cut))
        model.splits.append(split)
        model.leaves.append(rate * g / (h + ridge))
    return model


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, ridge: float = 1.0) -> Trees:
    """Boosted trees of rows in memory."""
    model = Trees([np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])])
    b = model.binned(x)
    return _grow(model, y.mean(), lambda split, width: _sums(b, y, model.add(b, np.full(len(b), model.start)), split, width), trees, depth, rate, ridge)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _grid(x: np.ndarray) -> np.ndarray:
    """Whole numbers, from 1024 on with their ten leading bits: a bounded number of values."""
    shift = np.maximum(np.frexp(np.maximum(x, 1).astype(np.float64))[1] - 10, 0)
    return x >> shift << shift


def bin_edges(rows: DataFrame) -> list[np.ndarray]:
    """For each feature the quantiles of all rows' values on ``_grid``, counted by Spark."""
    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for j, column in enumerate(_grid(_matrix(batch.column("x")).astype(np.int64)).T):
                v, n = np.unique(column, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), j)), pa.array(v), pa.array(n)], names=["feature", "value", "n"])

    found: dict[int, list[tuple[int, int]]] = {}
    for r in map_arrow(rows.select("x"), count, "feature long, value long, n long").groupBy("feature", "value").agg(F.sum("n").alias("n")).collect():
        found.setdefault(r.feature, []).append((r.value, r.n))
    edges = []
    for j in sorted(found):
        v, n = np.array(sorted(found[j])).T
        at = np.searchsorted(np.cumsum(n), np.linspace(0, 1, BINS + 1)[1:-1] * n.sum())
        edges.append(np.unique(v[at]).astype(np.float64))
    return edges


def boost_rows(rows: DataFrame, mean: float, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, ridge: float = 1.0) -> Trees:
    """Boosted trees of all ``rows`` (x, y), a written table, of which the share ``mean`` has y = 1: blocks of binned rows with their
    margins stay in Spark, a pass for each level of a tree sums gradients in the tasks and then over the tasks."""
    model = Trees(bin_edges(rows))
    spark, features = rows.sparkSession, len(model.edges)

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                b = model.binned(_matrix(batch.column("x"))).astype(np.uint8)
                y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in (b, y, np.zeros(len(y)))], names=["b", "y", "f"])

    def arrays(b, y, f):
        return np.frombuffer(b, np.uint8).reshape(-1, features), np.frombuffer(y), np.frombuffer(f).copy()

    def renewed(blocks, since):
        def run(batches):
            for batch in batches:
                new = [model.add(b, f, since).tobytes() for b, _, f in map(arrays, *(batch.column(c).to_pylist() for c in ("b", "y", "f")))]
                yield pa.RecordBatch.from_arrays([batch.column("b"), batch.column("y"), pa.array(new, pa.binary())], names=["b", "y", "f"])

        return written(spark, map_arrow(blocks, run, "b binary, y binary, f binary"), "pii-margins")

    state = {"blocks": written(spark, map_arrow(rows.select("x", "y"), pack, "b binary, y binary, f binary"), "pii-blocks"), "since": 0}

    def sums(split, width):
        since = state["since"]
        if len(model.leaves) - since >= REFRESH:
            state["blocks"], state["since"] = renewed(state["blocks"], since), len(model.leaves)
            state.pop("rdd", None)
            since = state["since"]
        if "rdd" not in state:
            state["rdd"] = state["blocks"].rdd
        later = Trees(splits=model.splits[since:], leaves=model.leaves[since:])
        start = model.start

        def add(total, row):
            b, y, f = arrays(row.b, row.y, row.f)
            own = _sums(b, y, later.add(b, f) + start, split, width)
            return own if total is None else total + own

        def both(one, other):
            return other if one is None else one if other is None else one + other

        # sums of few tasks meet in the driver, those of many in tasks first
        return state["rdd"].treeAggregate(None, add, both, 1 if state["rdd"].getNumPartitions() <= FEW_TASKS else 2)

    return _grow(model, mean, sums, trees, depth, rate, ridge)


# ---- training rows from base matches ----------------------------------------------

def _broken(value: str, kind: int, rng: np.random.Generator) -> str:
    """The value with what its check looks at destroyed."""
    d = only_digits(value)
    if kind == 0:
        return f"{value.split('@')[0]} at {rng.integers(1, 99)}"
    if kind == 1:
        return ".".join(str(int(x) + (300 if i == 1 else 0)) for i, x in enumerate(value.split(".")))
    if kind == 2:
        return d[:-1] + str((int(d[-1]) + int(rng.integers(1, 9))) % 10)
    n = lambda low, high, width=1: str(rng.integers(low, high)).zfill(width)
    year, month, day = n(1900, 2100), n(1, 13, 2), n(1, 32, 2)
    forms = [f"{year}-{month}-{day}", f"{day}.{month}.{year}", f"{month}/{day}/{year}", f"{year}-{month}-{day} {n(0, 24, 2)}:{n(0, 60, 2)}:{n(0, 60, 2)}",
             f"{n(0, 24, 2)}:{n(0, 60, 2)}:{n(0, 60, 2)}.{n(0, 1000, 3)}", f"{n(1, 10 ** 6)}.{n(0, 10 ** 6, 6)}", f"{year}-{n(1900, 2100)}", f"{n(1, 20)}.{n(0, 20)}.{n(0, 200000, 5)}",
             "".join(n(0, 10) for _ in range(int(rng.choice([7, 9, 12, 16, 18]))))]
    return forms[rng.integers(0, len(forms))]


def _rewritten(value: str, kind: int, rng: np.random.Generator) -> str:
    """Another way to write the value, of those that the generators look for."""
    pick = lambda *x: x[rng.integers(0, len(x))]
    if kind == 0:
        at, dot = pick(" at ", " (at) ", "[at]", "(at)", " @ "), pick(" dot ", "(dot)", "[dot]", "[.]")
        local, _, host = value.partition("@")
        return local + at + host.replace(".", dot)
    if kind == 1:
        return value.replace(".", pick("[.]", "(.)", " dot ", "[dot]", " . "))
    d = only_digits(value)
    if kind == 2:
        return pick(".", "/", "_", "  ", " - ", "\xa0").join(d[i:i + 4] for i in range(0, len(d), 4))
    local = d[-10:]
    return pick(f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"00{d[:-10]} {local[:3]} {local[3:6]} {local[6:]}",
                f"{local[:3]}.{local[3:6]}.{local[6:]}", f"+{d[:-10]}/{local[:3]}/{local[3:]}")


def training_rows(text: str, rng: np.random.Generator) -> Iterator[tuple[list[float], float]]:
    """(features, label) from one text."""
    base = base_spans(text)
    taken = [s for spans in base for s in spans]
    for kind, spans in enumerate(base):
        for start, end in spans:
            value = text[start:end]
            if kind == 3 and len(only_digits(value)) < 10:
                continue
            before, after = text[max(0, start - 60):start], text[end:end + 60]
            hint = HINTS[KINDS[kind]][rng.integers(0, len(HINTS[KINDS[kind]]))]
            for label, form in ((1.0, _rewritten(value, kind, rng)), (0.0, _rewritten(_broken(value, kind, rng), kind, rng) if kind in (1, 2) else _broken(value, kind, rng))):
                lead = before + (hint + " " if label and rng.random() < 0.5 else "")
                made = lead + form + after
                for k, a, b in candidates(made):
                    if a < len(lead) + len(form) and b > len(lead):
                        exact = (a, b) == (len(lead), len(lead) + len(form))
                        yield features(made, k, a, b), float(label and k == kind and exact)
    for k, a, b in candidates(text):
        if not any(a < e and b > s for s, e in taken):
            yield features(text, k, a, b), 0.0


@dataclass
class Model:
    trees: Trees | None = None
    scale: tuple[float, float] = (1.0, 0.0)  # calibration: probability = 1 / (1 + exp(-(a * margin + b)))
    thresholds: tuple[float, ...] = (2.0,) * 4

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-(a * self.trees.margin(x) + b)))

    def added(self, text: str, base: list[list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the candidates to redact besides ``base``."""
        if self.trees is None:
            return []
        found = list(candidates(text))
        if not found:
            return []
        # the base spans in order, each up to the furthest end so far: one search tells of an overlap
        taken = sorted(s for spans in base for s in spans)
        if taken:
            starts, ends = np.array([s for s, _ in taken]), np.maximum.accumulate([e for _, e in taken])
            last = np.searchsorted(starts, [b for _, _, b in found], side="left") - 1
            found = [c for c, k in zip(found, last) if k < 0 or ends[k] <= c[1]]
            if not found:
                return []
        p = self.probability(np.array([features(text, *c) for c in found]))
        good = sorted((-q, k, a, b) for q, (k, a, b) in zip(p.tolist(), found) if q >= self.thresholds[k])
        out: list[tuple[int, int, int]] = []
        free = np.ones(1, bool)
        if good:
            free = np.ones(max(b for *_, b in good) - min(a for _, _, a, _ in good), bool)
            low = min(a for _, _, a, _ in good)
        for _, k, a, b in good:
            if free[a - low:b - low].all():
                free[a - low:b - low] = False
                out.append((k, a, b))
        return out


def sample_kinds(text: str) -> int:
    """The kinds of which a text has base matches that make positives, as bits."""
    return sum(1 << k for k, spans in enumerate(base_spans(text))
               if any(k != 3 or len(only_digits(text[a:b])) >= 10 for a, b in spans))


def level(counts: dict, total: int) -> dict:
    """For each group the share to draw, so that about ``total`` stay and small groups stay whole."""
    shares, left = {}, float(total)
    for i, (group, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        take = min(float(n), left / (len(counts) - i))
        shares[group] = take / n
        left -= take
    return shares


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_texts: int | None = None, seed: int = 5) -> Model:
    """Learn from every text and all its candidates. ``max_texts``, for a quick model of a part only, draws about five times so many
    texts by hashes of the id, evenly over the sets of kinds that they have base matches of; rare sets are taken whole, and
    calibration and thresholds weigh a candidate by what it stands for."""
    d = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), text_or_empty(text_col).alias("text"))
    d = d.withColumn("draw", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)))

    def kinds(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sample_kinds(t) for t in batch.column("text").to_pylist()], pa.int64())], names=["kinds"])

    share = None
    if max_texts is not None:
        share = level({r.kinds: r.n for r in map_arrow(d.select("text"), kinds, "kinds long").groupBy("kinds").agg(F.count(F.lit(1)).alias("n")).collect()}, 5 * max_texts)

    def rows(batches):
        for batch in batches:
            x, y, aside, stands = [], [], [], []
            for i, t, draw in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), batch.column("draw").to_pylist()):
                own = 1.0 if share is None else share[sample_kinds(t)]
                if draw >= int(own * (1 << 30)):
                    continue
                rng = np.random.default_rng(int.from_bytes(hashlib.blake2b(f"{seed} {i}".encode(), digest_size=8).digest(), "big"))
                for f, label in training_rows(t, rng):
                    x.append([int(v) for v in f])
                    y.append(label)
                    aside.append(bool(rng.random() < ASIDE))
                    stands.append(1 / own)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int32())), pa.array(y, pa.float64()), pa.array(aside, pa.bool_()), pa.array(stands, pa.float64())],
                                             names=["x", "y", "aside", "stands"])

    made = written(docs.sparkSession, map_arrow(d, rows, "x array<int>, y double, aside boolean, stands double"), "pii-rows")
    n = {(r.aside, r.y): r.n for r in made.groupBy("aside", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not (n.get((False, 0.0)) and n.get((False, 1.0)) and (n.get((True, 0.0)) or n.get((True, 1.0)))):
        return Model()
    model = Model(boost_rows(made.where("NOT aside"), n[False, 1.0] / (n[False, 0.0] + n[False, 1.0])))

    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                cell = np.floor(model.trees.margin(x) * CELLS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, :4].argmax(axis=1)), batch.column("y"), pa.array(cell), batch.column("stands")], names=["kind", "y", "cell", "stands"])

    # all rows put aside, counted by kind, label and cell of the margin
    counted = (map_arrow(made.where("aside").select("x", "y", "stands"), cells, "kind long, y double, cell long, stands double")
               .groupBy("kind", "y", "cell").agg(F.sum("stands").alias("stands")).orderBy("kind", "cell", "y").collect())
    kind, t, m, u = (np.array([r[c] for r in counted], np.float64) for c in ("kind", "y", "cell", "stands"))
    m /= CELLS
    u *= (n.get((True, 0.0), 0) + n.get((True, 1.0), 0)) / u.sum()
    a, b = 1.0, 0.0
    for _ in range(50):  # logistic calibration, Newton steps with a little ridge
        p = 1 / (1 + np.exp(-(a * m + b)))
        w = u * p * (1 - p)
        g = np.array([(u * (t - p) * m).sum() - 0.01 * (a - 1), (u * (t - p)).sum() - 0.01 * b])
        h = np.array([[(w * m * m).sum() + 0.01, (w * m).sum()], [(w * m).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -0.5, 0.5), b + np.clip(step[1], -1, 1)
    model.scale = (float(max(a, 0.05)), float(b))
    cuts = []
    for k in range(4):
        own = kind == k
        margins, at = np.unique(-m[own], return_inverse=True)  # the likeliest first
        right, of = np.bincount(at, (t * u)[own], len(margins)).cumsum(), np.bincount(at, u[own], len(margins)).cumsum()
        precise = np.flatnonzero(right / of >= PRECISION)
        cuts.append(max(0.5, float(1 / (1 + np.exp(model.scale[0] * margins[precise[-1]] - model.scale[1])))) if len(precise) else 2.0)
    model.thresholds = tuple(cuts)
    return model


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (kind, start, end), each by kind in the order of
    ``KINDS``, then start. ``spans`` holds the base spans and what the model adds."""
    key = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            base, every = [], []
            for t in batch.column("text"):
                text = t.as_py()
                found = base_spans(text)
                own = [(k, a, b) for k, spans in enumerate(found) for a, b in spans]
                base.append([(KINDS[k], a, b) for k, a, b in own])
                every.append([(KINDS[k], a, b) for k, a, b in sorted(own + model.added(text, found))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in x], span) for x in (base, every)]],
                                             names=["id", "base", "spans"])

    d = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return map_arrow(d, run, f"id {key}, base {kind}, spans {kind}").withColumnRenamed("id", id_col)
