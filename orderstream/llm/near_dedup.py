"""MinHash near-dedup (operator 7): ProbMinHash, banding, verification.

A document is a weighted set of shingles of ``shingle`` consecutive words (ASCII
letters and digits and everything beyond ASCII, A-Z in lower case; a text of
fewer words, but not none, is one shingle); a shingle that occurs c times weighs
1 + ln(c) / 8. Every shingle is a Poisson process of its weight as rate, driven by its hash:
its arrivals go to random registers, a register keeps the shingle that came
first, and a process ends early when its next arrival is later than the latest
register of its document. Two documents agree in a register with the probability
of their probability Jaccard similarity. A document with repeated shingles has a second,
plain set of registers in which every shingle weighs 1, so that two documents agree there
with the probability of their plain Jaccard similarity; without repeats the two sets are equal.

Candidates agree in a whole band of registers, weighted or plain. Texts of the same word sequence
are one vertex from the start. In each band bucket every vertex is first held against
one centre, the member that shares most buckets with others, so a group of m near
copies costs about m verifications. Only members whose bucket then still shows
several components are held against the members of the other components, with
the agreement of finer sketches, weighted or plain, as a join condition; what is already
connected or verified isn't compared again, and no other pair is left out. The members of
a large bucket are dealt to blocks, and each pair of blocks is a key of its own. Links are verified
on whole texts: the exact probability Jaccard, or the plain Jaccard of the shingle sets,
reaches the threshold. Classes are the connected components of the links. Where a bucket, a centre, a word
sequence or a class holds a large part of all rows, its joins are spread over tasks.

Defined cases: null, empty and wordless texts have no shingles and stand alone;
a row without id gets the class of its copies, or null; rows that share an id are
one document; repeated rows fall in one class; an empty table gives an empty
result; other columns never matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, sliced, text_or_empty, unused, written
from orderstream.llm.components import connected_components
from orderstream.llm.id_sets import id_number, keep_members, write_id_set
from orderstream.llm.spread import FLOOR, block_of, hot_keys, join_spread
from orderstream.llm.words import ALNUM, U, hash_batch, mix

REGISTERS, BANDS, ROWS = 256, 28, 6
#: How far under the threshold an estimate from the registers, or from the finer sketch of the
#: second round, may be for a pair to be verified: more than three standard errors.
FINE_REGISTERS = 1024
SLACK, FINE_SLACK = 0.1, 0.05
#: So many shingles still in play or less are few: numpy's own overhead counts more than the arrivals.
FEW = 2000
#: So many members of a bucket are compared in one task of the second round; so many pairs of one text are verified in one.
BLOCK, PAIRS = 1024, 4096
#: Bytes of text that a Python worker hashes at a time: its arrays take some thirty times as much.
TEXT_BYTES = 512 << 10
#: A shingle that occurs 8 times weighs a quarter more than one that occurs once: a text
#: that repeats a line is told by its other shingles too.
DAMPING = 8.0
GOLD = U(0x9E3779B97F4A7C15)


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes without repeats, counts, first shingle of each text with the end, word-sequence keys).
    The keys are pairs of 64-bit numbers; (0, 0) for a text without words."""
    h, at = hash_batch(column, ALNUM)
    n = np.diff(at)
    with np.errstate(over="ignore"):
        keys = np.zeros((len(n), 2), U)
        for j, salt in enumerate((U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB))):
            place = np.arange(len(h), dtype=U) - np.repeat(at[:-1].astype(U), n)
            run = np.concatenate([np.zeros(1, U), np.cumsum(mix(h + (place + U(1)) * salt) * (mix(place * salt) | U(1)), dtype=U)])
            keys[:, j] = np.where(n > 0, mix(run[at[1:]] - run[at[:-1]] + n.astype(U)) | U(1), U(0))
        full = np.maximum(n - k + 1, 0)
        parts = np.zeros(max(len(h) - k + 1, 0), U)
        for j in range(k):
            parts = parts * U(0x2545F4914F6CDD1D) + mix(h[j:len(h) - k + 1 + j] + U(j + 1) * GOLD) if len(parts) else parts
    out, counts, ends = [], [], [0]
    for i in range(len(n)):
        if n[i] == 0:
            found, c = np.empty(0, U), np.empty(0, np.int64)
        elif full[i]:
            found, c = np.unique(mix(parts[at[i]:at[i] + full[i]]), return_counts=True)
        else:
            found, c = keys[i, :1], np.ones(1, np.int64)
        out.append(found)
        counts.append(c)
        ends.append(ends[-1] + len(found))
    none = [np.empty(0, U)]
    return np.concatenate(out or none), np.concatenate(counts or none).astype(np.float64), np.asarray(ends), keys


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts) / DAMPING


def signatures(x: np.ndarray, w: np.ndarray, starts: np.ndarray, k: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (texts x k) of shingle hashes ``x`` with weights ``w``;
    text i owns x[starts[i]:starts[i+1]]. Texts without shingles keep zeros."""
    texts = len(starts) - 1
    sig = np.zeros(texts * k, U)
    time = np.full(texts * k, np.inf)
    doc = np.repeat(np.arange(texts), np.diff(starts))
    now, latest = np.zeros(len(x)), np.full(texts, np.inf)
    state = mix(x ^ U(0x5851F42D4C957F2D))
    rank = 0
    while len(x):
        steps = 1 if len(x) > FEW else 32  # a few processes run several arrivals at a time
        with np.errstate(over="ignore"):
            ranks = U(2) * np.arange(rank + 1, rank + 1 + steps, dtype=U)
            r1, r2 = mix(state[:, None] + ranks * GOLD), mix(state[:, None] + (ranks + U(1)) * GOLD)
        rank += steps
        times = now[:, None] - np.cumsum(np.log(((r1 >> U(11)).astype(np.float64) + 0.5) / 9007199254740992.0), axis=1) / w[:, None]
        row, step = np.nonzero(times < latest[doc][:, None])
        at = times[row, step]
        slot = doc[row] * k + (r2[row, step] % U(k)).astype(np.int64)
        np.minimum.at(time, slot, at)
        first = time[slot] == at
        sig[slot[first]] = x[row[first]]
        now = times[:, -1]
        active = doc[np.flatnonzero(np.diff(doc, prepend=-1))]
        latest[active] = time.reshape(texts, k)[active].max(axis=1)
        go = now < latest[doc]
        x, w, doc, now, state = x[go], w[go], doc[go], now[go], state[go]
    return sig.reshape(texts, k)


def band_hashes(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.zeros((len(sig), BANDS), U)
        for b in range(BANDS):
            h = np.full(len(sig), U(b + 1) * GOLD, U)
            for r in range(ROWS):
                h = mix(h * U(0x2545F4914F6CDD1D) + sig[:, b * ROWS + r])
            out[:, b] = h
        return out


def sketches(sig: np.ndarray) -> np.ndarray:
    """Two bits of each register, 32 registers to a 64-bit word."""
    bits = (mix(sig) & U(3)).reshape(len(sig), sig.shape[1] // 32, 32)
    return np.bitwise_or.reduce(bits << (U(2) * np.arange(32, dtype=U)), axis=2)


def repeating(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a text has a shingle that occurs more than once: only there plain registers differ."""
    more = np.concatenate([[0], np.cumsum(counts > 1)])
    return more[starts[1:]] > more[starts[:-1]]


def plain_signatures(x: np.ndarray, starts: np.ndarray, texts: np.ndarray, k: int = REGISTERS) -> np.ndarray:
    """Registers of the texts marked in ``texts`` with every shingle of weight 1."""
    n = np.diff(starts)
    own = x[np.repeat(texts, n)]
    return signatures(own, np.ones(len(own)), np.concatenate([[0], np.cumsum(n[texts])]), k)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.view(np.int64).ravel()), rows.shape[1]).cast(pa.list_(pa.int64()))


def _lists_where(rows: np.ndarray, where: np.ndarray) -> pa.Array:
    """The rows at the places marked in ``where``, null elsewhere."""
    at = np.where(where, np.cumsum(where) - 1, 0)
    return _lists(rows).take(pa.array(at, mask=~where))


def _buckets(bands: np.ndarray, plain: np.ndarray, where: np.ndarray) -> pa.Array:
    """The bands of each text, with the plain ones that differ."""
    also = np.zeros_like(bands)
    also[where] = plain
    keep = np.ones((len(bands), 2 * BANDS), bool)
    keep[:, BANDS:] = where[:, None] & (also != bands)
    ends = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([bands, also], axis=1)[keep].view(np.int64)))


def _sign_finely(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", TEXT_BYTES):
        x, c, starts, _ = shingles(batch.column("text"), k)
        again = repeating(c, starts)
        plain = _lists_where(sketches(plain_signatures(x, starts, again, FINE_REGISTERS)), again)
        yield pa.RecordBatch.from_arrays([batch.column("v"), _lists(sketches(signatures(x, weights(c), starts, FINE_REGISTERS))), plain],
                                         names=["v", "fine", "fine_plain"])


def _sign(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", TEXT_BYTES):
        x, c, starts, keys = shingles(batch.column("text"), k)
        sig = signatures(x, weights(c), starts)
        n = len(sig)
        empty = pa.array(np.diff(starts) == 0)
        again = repeating(c, starts)
        plain = plain_signatures(x, starts, again)
        bands = _buckets(band_hashes(sig), band_hashes(plain), again)
        sketch = _lists(sketches(sig))
        none = pa.nulls(n, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pc.if_else(empty, none, pa.array(keys[:, 0].view(np.int64))),
             pc.if_else(empty, none, pa.array(keys[:, 1].view(np.int64))), bands, sketch,
             _lists_where(sketches(plain), again)],
            names=["id", "key1", "key2", "bands", "sketch", "plain"])


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Exact (probability Jaccard, plain Jaccard) of two weighted sets given as
    (sorted hashes, weights)."""
    (xa, wa), (xb, wb) = a, b
    both, ia, ib = np.intersect1d(xa, xb, assume_unique=True, return_indices=True)
    union = len(xa) + len(xb) - len(both)
    if not len(both):
        return 0.0, 0.0
    wa_all, wb_all = wa.sum(), wb.sum()
    u, v = wa[ia], wb[ib]
    # the sum over all y of max(a_y / a_x, b_y / b_x): a's part for ratios b_y / a_y
    # up to that of x, b's part beyond; y only in a has ratio 0, only in b infinity
    ratio = v / u
    order = np.argsort(ratio, kind="stable")
    ratio, u, v = ratio[order], u[order], v[order]
    a_up = np.concatenate([[0.0], np.cumsum(u)]) + (wa_all - u.sum())
    b_up = np.concatenate([[0.0], np.cumsum(v)])
    upto = np.searchsorted(ratio, ratio, side="right")
    total = a_up[upto] / u + (wb_all - b_up[upto]) / v
    return float((1.0 / total).sum()), len(both) / union


def _verify(batches: Iterator[pa.RecordBatch], k: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in sliced(sliced(batches, "text_a", TEXT_BYTES), "text_b", TEXT_BYTES):
        sides = []
        for name in ("text_a", "text_b"):
            x, c, starts, _ = shingles(batch.column(name), k)
            sides.append((x, weights(c), starts))
        (xa, wa, sa), (xb, wb, sb) = sides
        keep = []
        for i in range(batch.num_rows):
            a, b = slice(sa[i], sa[i + 1]), slice(sb[i], sb[i + 1])
            keep.append(max(probability_jaccard((xa[a], wa[a]), (xb[b], wb[b]))) >= threshold - 1e-9)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _agreement(x: str, y: str, registers: int) -> Column:
    """Estimated similarity of two sketches: the share of registers with equal bits
    is J + (1 - J) / 4."""
    even = 0x5555555555555555
    differ = None
    for i in range(registers * 2 // 64):
        z = F.col(x)[i].bitwiseXOR(F.col(y)[i])
        n = F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(even)))
        differ = n if differ is None else differ + n
    return (F.lit(1.0) - differ / F.lit(float(registers)) - 0.25) / 0.75


def _likely(a: str, b: str, registers: int, least: float) -> Column:
    """Whether the weighted or the plain estimate of columns named after ``a`` and ``b`` is at least ``least``."""
    plain = (F.col(f"repeats_{a}") | F.col(f"repeats_{b}")) & (_agreement(f"plain_{a}", f"plain_{b}", registers) >= least)
    return (_agreement(f"sketch_{a}", f"sketch_{b}", registers) >= least) | plain


def _sketch_of(v: str, sketch: str, plain: str) -> list[Column]:
    return [F.col(sketch).alias(f"sketch_{v}"), F.coalesce(plain, sketch).alias(f"plain_{v}"), F.col(plain).isNotNull().alias(f"repeats_{v}")]


def _first_shared(x: str, y: str) -> Column:
    """The lowest bucket that two vertices share, so that a pair is taken from one bucket only."""
    return F.array_min(F.array_intersect(x, y))


def _with_ends(pairs: DataFrame, table: Callable[[str], DataFrame], floor: int) -> DataFrame:
    """The pairs (a, b), a written table, joined with ``table(end)`` at both ends."""
    total, both = pairs.count(), pairs
    for v, other in (("a", "b"), ("b", "a")):
        hot = hot_keys(pairs.groupBy(v).agg(F.count(F.lit(1)).alias("n")), [v], "n", floor, total)
        both = join_spread(both, table(v), [v], hot, other)
    return both


def _verified(pairs: DataFrame, texts: DataFrame, key: str, shingle: int, threshold: float, most: int) -> DataFrame:
    """The pairs (a, b), a written table, whose whole texts reach the threshold. A text with more than ``most`` pairs, a centre,
    is copied to several tasks."""
    both = _with_ends(pairs, lambda v: texts.select(F.col("v").alias(v), F.col("text").alias(f"text_{v}")), most)
    return map_arrow(both.select("a", "b", "text_a", "text_b"), lambda it: _verify(it, shingle, threshold), f"a {key}, b {key}")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                 threshold: float = 0.8, block: int = BLOCK, most: int = PAIRS, floor: int = FLOOR) -> DataFrame:
    """A row for each input row: id, class_id (the smallest id of its class),
    class_size (rows of the class), kept (the id is its class's). ``block``, ``most`` and ``floor``
    are sizes beyond which the work of a bucket, a text or a class is split; results don't depend on them."""
    spark = docs.sparkSession
    key = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    signed = written(spark, map_arrow(d, lambda it: _sign(it, shingle),
                                      f"id {key}, key1 long, key2 long, bands array<bigint>, sketch array<bigint>, plain array<bigint>"), "near-signed")

    # one vertex for each word sequence, named by its smallest id
    vertex = written(spark, signed.where("key1 IS NOT NULL").groupBy("key1", "key2")
                     .agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")), "near-vertices")
    hot_vertex = hot_keys(vertex, ["key1", "key2"], "n", floor)
    reps = (join_spread(signed, vertex.where("v IS NOT NULL").select("key1", "key2", "v"), ["key1", "key2"], hot_vertex, "id")
            .where("id = v").select("v", "bands", "sketch", "plain"))
    rows = reps.select("v", F.explode("bands").alias("bucket"))
    sizes = written(spark, rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-bucket-sizes")
    hot_bucket = hot_keys(sizes, ["bucket"], "n", floor)
    shared = written(spark, join_spread(rows, sizes, ["bucket"], hot_bucket, "v"), "near-buckets")
    members = shared.select("v").distinct()
    sketch = written(spark, reps.join(members, "v", "left_semi").dropDuplicates(["v"]), "near-sketches")
    # the texts of these alone, picked where they are read: most documents share no bucket
    numbered = d.withColumn("number", id_number(F.col("id"), key))
    texts = written(spark, keep_members(numbered, "number", write_id_set(members, "v", "near-members"))
                    .select(F.col("id").alias("v"), "text"), "near-texts")

    # first round: every member against its bucket's centre
    reach = shared.groupBy("v").agg(F.sum("n").alias("reach"))
    ranked = shared.join(reach, "v").withColumn(
        "rank", F.least(F.col("reach"), F.lit(1 << 40)) * F.lit(1 << 20) + F.pmod(F.xxhash64("v"), F.lit(1 << 20)))
    centres = ranked.groupBy("bucket").agg(F.max_by("v", "rank").alias("centre"))
    star = written(spark, join_spread(shared, centres, ["bucket"], hot_bucket, "v").where("v != centre")
                   .select(F.least("v", "centre").alias("a"), F.greatest("v", "centre").alias("b")).distinct(), "near-star")
    likely = (_with_ends(star, lambda v: sketch.select(F.col("v").alias(v), *_sketch_of(v, "sketch", "plain")), floor)
              .where(_likely("a", "b", REGISTERS, threshold - SLACK)).select("a", "b"))
    likely = written(spark, likely, "near-likely")
    links = written(spark, _verified(likely, texts, key, shingle, threshold, most), "near-links")
    comp = connected_components(links, floor=floor)

    # second round: where a bucket still shows several components, members outside
    # the centre's component against the members of all other components, the centre too:
    # a pair that the first round's sketches refused is told by the finer ones
    labelled = (shared.select("bucket", "v").join(comp, "v", "left")
                .select("bucket", "v", F.coalesce("component", "v").alias("c")))
    mixed = (labelled.groupBy("bucket").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("members"))
             .where("low != high").join(centres, "bucket")
             .select("bucket", "centre", F.ceil(F.col("members") / F.lit(block)).cast("int").alias("blocks")))
    open_rows = written(spark, join_spread(labelled, mixed, ["bucket"], hot_bucket, "v"), "near-open")
    fine = map_arrow(texts.join(open_rows.select("v").distinct(), "v", "left_semi"), lambda it: _sign_finely(it, shingle), f"v {key}, fine array<bigint>, fine_plain array<bigint>")
    fine = written(spark, fine.join(sketch.select("v", "bands"), "v"), "near-fine")
    main = open_rows.where("v = centre").select("bucket", F.col("c").alias("main"))
    open_rows = written(spark, join_spread(open_rows, main, ["bucket"], hot_bucket, "v").join(fine, "v"), "near-open-signed")
    # block i of the rest meets block j of all members under the key (bucket, i, j)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rest = open_rows.where("c != main").select(
        "bucket", block_of("v", F.col("blocks")).alias("i"), every.alias("j"), F.col("v").alias("u"), F.col("c").alias("cu"),
        F.col("bands").alias("bu"), *_sketch_of("u", "fine", "fine_plain"))
    right = open_rows.select(
        "bucket", block_of("v", F.col("blocks")).alias("j"), every.alias("i"), F.col("v").alias("w"), F.col("c").alias("cw"),
        F.col("bands").alias("bw"), "main", *_sketch_of("w", "fine", "fine_plain"))
    cross = (rest.join(right, (rest["bucket"] == right["bucket"]) & (rest["i"] == right["i"]) & (rest["j"] == right["j"])
                       & (F.col("cu") != F.col("cw"))
                       & ((F.col("cw") == F.col("main")) | (F.col("u") < F.col("w")))
                       & _likely("u", "w", FINE_REGISTERS, threshold - FINE_SLACK)
                       & (_first_shared("bu", "bw") == rest["bucket"]))
             .select(F.least("u", "w").alias("a"), F.greatest("u", "w").alias("b")).distinct())
    cross = written(spark, cross.join(likely, ["a", "b"], "left_anti"), "near-cross")
    more = written(spark, _verified(cross, texts, key, shingle, threshold, most), "near-more-links")
    comp = connected_components(links.unionByName(more), known=comp, floor=floor)

    # a class has the rows of its vertices; copies without any id are a class without a name
    named = written(spark, vertex.join(comp, "v", "left")
                    .select("key1", "key2", "v", "n", F.coalesce("component", "v").alias("class_id")), "near-named")
    sizes = written(spark, named.where("class_id IS NOT NULL").groupBy("class_id").agg(F.sum("n").alias("class_size"), F.count(F.lit(1)).alias("vertices")), "near-sizes")
    hot_class = hot_keys(sizes, ["class_id"], "vertices", floor)
    sized = join_spread(named, sizes.drop("vertices"), ["class_id"], hot_class, "v", "left")
    sized = sized.select("key1", "key2", "class_id", F.coalesce("class_size", "n").alias("class_size"))
    out = join_spread(signed.where("key1 IS NOT NULL").select("id", "key1", "key2"), sized, ["key1", "key2"], hot_vertex, "id")
    out = out.select("id", "class_id", "class_size")
    out = out.unionByName(signed.where("key1 IS NULL").select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size")))
    return out.select(F.col("id").alias(id_col), "class_id", "class_size", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
             threshold: float = 0.8) -> DataFrame:
    """The document with the smallest id of each class, with the columns of ``docs``;
    repeated rows of that id stay once, rows without id stay as they are."""
    classes = near_classes(docs, id_col, text_col, shingle, threshold).where("kept").select(F.col(id_col).alias("kept_id"))
    place = unused(docs.columns, "place")
    kept = docs.join(classes, docs[id_col] == classes["kept_id"], "left_semi")
    one = Window.partitionBy(f"`{id_col}`").orderBy(f"`{id_col}`")
    kept = kept.withColumn(place, F.row_number().over(one)).where(F.col(place) == 1).drop(place)
    return kept.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
