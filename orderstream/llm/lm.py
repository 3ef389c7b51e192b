"""LM scoring (operator 5): an interpolated modified Kneser-Ney model of order 2 or 3.

Counting runs in Spark on numpy arrays. Every task turns its texts into 64-bit word
hashes, counts them in bounded buffers and sends sorted (key, count) blocks to
shards; a shard adds up its blocks and writes two plain files under the shared
checkpoint folder: its keys, sorted, and their counts. The vocabulary is such an
array of word hashes, and a word's id is its rank in it; the bigrams are arrays of id pairs.
At order 3 the triples are counted instead, and pairs and their continuation counts follow from them (``lm_triples``).
Workers map the files into memory and search them, so scoring is one pass over
the texts without a shuffle.

A context with more than its share of all tokens is split over shards by the
following word. What the model needs besides counts, the numbers of different
words around each word, is added up in blocks of ids in the same way. Only totals
(tokens, types, counts of counts) reach the driver.

Tokens: words are runs of anything but blank, tab, line and page breaks, A-Z in
lower case; each text has one end token, and a beginning that is only a context (at order 3 before itself too).

Defined cases: a null or empty text is one end token; without training texts the
model is uniform over no word but the unknown one, so all scores are 0; words and
contexts that were never seen fall back to lower orders; repeated rows count and
are scored each; other columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm import lm_triples
from orderstream.llm.common import map_arrow, shared_arrays, sliced, text_or_empty, write_file
from orderstream.llm.words import UNBLANK, U, hash_batch, mix
from orderstream.session import scratch_path

END = U(0x1B873593CC9E2D51)  # the end token's hash; words' hashes are mixed numbers like any
FLUSH_TOKENS = 2 << 20
BLOCK_BITS = 16
ENCODED = "shard long, keys binary, counts binary"


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes with an end token after each text, first token of each text with the total)."""
    h, at = hash_batch(column, UNBLANK)
    texts = len(at) - 1
    out = np.empty(len(h) + texts, U)
    ends = at[1:] + np.arange(texts)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word], out[ends] = h, END
    return out, np.concatenate([[0], ends + 1])


def _blocks(keys: np.ndarray, shard: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One record for each shard among the keys; keys stay sorted within it."""
    order = np.argsort(shard, kind="stable")
    keys, shard, counts = keys[order], shard[order], counts[order]
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(cut, [*cut[1:], len(keys)]):
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(shard[a])], pa.int64()), pa.array([keys[a:b].tobytes()], pa.binary()),
             pa.array([counts[a:b].astype(np.uint32).tobytes()], pa.binary())], names=["shard", "keys", "counts"])


def _by_shard(batches: Iterator[pa.RecordBatch], columns: int = 2) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The records of each shard, of a partition that is sorted by shard."""
    now, held = None, [[] for _ in range(columns)]
    for batch in batches:
        shards = batch.column(0).to_pylist()
        for i, s in enumerate(shards):
            if s != now and now is not None:
                yield now, held
                held = [[] for _ in range(columns)]
            now = s
            for c in range(columns):
                held[c].append(batch.column(c + 1)[i].as_py())
    if now is not None:
        yield now, held


def _added(held: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(b"".join(held[0]), U)
    counts = np.frombuffer(b"".join(held[1]), np.uint32)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first)


def _discounts(n: list[float]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more, from the numbers
    of entries with counts 1 to 4."""
    n1, n2, n3, n4 = n
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d[k], 0.05), k - 0.05) for k in (1, 2, 3))])


@dataclass
class Model:
    """Totals, and where the arrays are. Arrays are mapped on first use by a process."""
    folder: str
    shards: int  # a power of 2
    block_bits: int = BLOCK_BITS  # ids to a block of the numbers of words around
    order: int = 3
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # id of each vocabulary shard's first word
    tokens: int = 0
    texts: int = 0
    pair_types: int = 0
    discounts: np.ndarray | None = None
    triple_discounts: np.ndarray | None = None
    unigram_discounts: np.ndarray | None = None
    unigram_mass: float = 0.0  # what the discounts take off the continuation counts, as a share

    @property
    def words(self) -> int:
        return int(self.offsets[-1])

    @property
    def begin(self) -> int:
        """The id of the beginning of a text, a context only."""
        return self.words

    def shard_of_hash(self, h: np.ndarray) -> np.ndarray:
        return (h >> U(64 - (self.shards.bit_length() - 1))).astype(np.int64) if self.shards > 1 else np.zeros(len(h), np.int64)

    def is_hot(self, count: np.ndarray) -> np.ndarray:
        return count > max(self.tokens // (4 * self.shards), 1)

    def shard_of_pair(self, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
        hot = self.is_hot(left_count)
        with np.errstate(over="ignore"):
            return (mix(left.astype(U) * U(2) + U(1) + np.where(hot, mix(right.astype(U)), U(0))) & U(self.shards - 1)).astype(np.int64)

    def array(self, name: str, dtype) -> np.ndarray:
        return shared_arrays.get(f"{self.folder}/{name}", dtype)

    def look_up_words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of sorted word hashes; unknown: -1 and 0."""
        ids, counts = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        cuts = np.searchsorted(self.shard_of_hash(h), np.arange(self.shards + 1))
        for s in range(self.shards):
            part = slice(cuts[s], cuts[s + 1])
            if cuts[s] == cuts[s + 1] or self.offsets[s] == self.offsets[s + 1]:
                continue
            keys = self.array(f"words-{s}.keys", U)
            at = np.minimum(np.searchsorted(keys, h[part]), len(keys) - 1)
            found = keys[at] == h[part]
            ids[part] = np.where(found, at + self.offsets[s], -1)
            counts[part] = np.where(found, self.array(f"words-{s}.counts", np.int64)[at], 0)
        return ids, counts

    def around(self, ids: np.ndarray) -> np.ndarray:
        """For sorted ids: numbers of different followers seen once, twice, more often, of different predecessors, and
        the followers' counts in all."""
        out = np.zeros((len(ids), 5), np.int64)
        blocks = ids >> self.block_bits
        for b in np.unique(blocks):
            part = slice(*np.searchsorted(blocks, [b, b + 1]))
            out[part] = self._block(int(b))[ids[part] - (b << self.block_bits)]
        return out

    def block_size(self, b: int) -> int:
        return min(1 << self.block_bits, self.words + 1 - (b << self.block_bits))

    def _block(self, b: int) -> np.ndarray:
        stored = self.array(f"around-{b}", np.uint8)  # of the narrowest type that holds the block's largest
        return stored.view(f"u{len(stored) // (5 * self.block_size(b))}").reshape(-1, 5)

    def pair_counts(self, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
        if self.order == 3:
            return self._continuations(left, right, left_count)
        out = np.zeros(len(left), np.int64)
        keys, shard = left.astype(U) << U(32) | right.astype(U), self.shard_of_pair(left, right, left_count)
        order = np.lexsort((keys, shard))
        keys, cuts = keys[order], np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in range(self.shards):
            if cuts[s] == cuts[s + 1]:
                continue
            own = self.array(f"pairs-{s}.keys", U)
            if not len(own):
                continue
            part = keys[cuts[s]:cuts[s + 1]]
            at = np.minimum(np.searchsorted(own, part), len(own) - 1)
            counts = self.array(f"pairs-{s}.counts", np.uint8)  # of the narrowest type that holds the shard's largest
            counts = counts.view(f"u{len(counts) // len(own)}")
            out[order[cuts[s]:cuts[s + 1]]] = np.where(own[at] == part, counts[at].astype(np.int64), 0)
        return out

    def _continuations(self, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
        """The number of different words before each pair."""
        out, hot = np.zeros(len(left), np.int64), self.is_hot(left_count)
        for name, own in (("pairs", np.flatnonzero(~hot)), ("hot", np.flatnonzero(hot))):
            for s, part in _by(self.shard_of_pair(left[own], right[own], left_count[own])):
                at = own[part]
                out[at] = lm_triples.pair_counts(self.folder, name, s, left[at], right[at])
        return out

    def triples(self, left: np.ndarray, middle: np.ndarray, third: np.ndarray, middle_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of triples, and of their contexts (total; followers seen once, twice, more often)."""
        counts, sums = np.zeros(len(left), np.int64), np.zeros((len(left), 4), np.int64)
        for s, at in _by(self.shard_of_pair(middle, left, middle_count)):
            counts[at], sums[at] = lm_triples.triple_counts(self.folder, s, middle[at], left[at], third[at])
        return counts, sums


def _by(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with its places."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, z in zip(cuts, [*cuts[1:], len(order)]):
        yield int(shard[order[a]]), order[a:z]


def _dealt(df: DataFrame, shards: int) -> DataFrame:
    return df.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard")


def train(docs: DataFrame, text_col: str = "text", flush_tokens: int = FLUSH_TOKENS, block_bits: int = BLOCK_BITS,
          order: int = 3) -> Model:
    """Count all texts of ``docs`` and write the model's arrays."""
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark = docs.sparkSession
    texts = docs.select(text_or_empty(text_col).cast("binary").alias("text"))
    shards = 1 << max(4, (max(1, texts.rdd.getNumPartitions()) - 1).bit_length())  # grows with the input
    model = Model(scratch_path(spark, "lm"), shards, block_bits, order)

    def count_words(batches):
        held, size = [], 0
        for batch in sliced(batches, "text"):
            held.append(_tokens(batch.column("text"))[0])
            size += len(held[-1])
            if size >= flush_tokens:
                yield from flush_words(held)
                held, size = [], 0
        if size:
            yield from flush_words(held)

    def flush_words(held):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        yield from _blocks(keys, model.shard_of_hash(keys), counts)

    def add_words(batches):
        for s, held in _by_shard(batches):
            keys, counts = _added(held)
            write_file(f"{model.folder}/words-{s}.keys", keys.tobytes())
            write_file(f"{model.folder}/words-{s}.counts", counts.tobytes())
            ends = counts[keys == END]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (s, len(keys), int(counts.sum()), int(ends.sum()))],
                                             names=["shard", "types", "tokens", "texts"])

    words = (_dealt(map_arrow(texts, count_words, ENCODED), shards)
             .mapInArrow(add_words, "shard long, types long, tokens long, texts long").collect())
    sizes = np.zeros(shards, np.int64)
    for r in words:
        sizes[r.shard] = r.types
    model = Model(model.folder, shards, block_bits, order, np.concatenate([[0], np.cumsum(sizes)]), sum(r.tokens for r in words), sum(r.texts for r in words))
    if model.words >= (1 << 32) - 1:
        raise ValueError("more than 2^32 - 2 different words")

    def count_pairs(batches):
        held, size = [], 0
        for batch in sliced(batches, "text"):
            h, at = _tokens(batch.column("text"))
            known, back = np.unique(h, return_inverse=True)
            ids = model.look_up_words(known)[0][back]
            left = np.empty_like(ids)
            left[1:] = ids[:-1]
            left[at[:-1]] = model.begin
            held.append(left.astype(U) << U(32) | ids.astype(U))
            size += len(ids)
            if size >= flush_tokens:
                yield from flush_pairs(held)
                held, size = [], 0
        if size:
            yield from flush_pairs(held)

    def flush_pairs(held):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        left, right = (keys >> U(32)).astype(np.int64), (keys & U(0xFFFFFFFF)).astype(np.int64)
        yield from _blocks(keys, model.shard_of_pair(left, right, count_of(left)), counts)

    def count_of(ids):
        """Occurrences of sorted ids as contexts, from the vocabulary's shards."""
        out = np.full(len(ids), model.texts, np.int64)
        cuts = np.searchsorted(ids, model.offsets)
        for s in range(model.shards):
            if cuts[s] < cuts[s + 1]:
                out[cuts[s]:cuts[s + 1]] = model.array(f"words-{s}.counts", np.int64)[ids[cuts[s]:cuts[s + 1]] - model.offsets[s]]
        return out

    def add_pairs(batches):
        for s, held in _by_shard(batches):
            keys, counts = _added(held)
            write_file(f"{model.folder}/pairs-{s}.keys", keys.tobytes())
            write_file(f"{model.folder}/pairs-{s}.counts", counts.astype(np.min_scalar_type(int(counts.max()))).tobytes())
            yield from _around_rows(keys, counts, block_bits)
            yield _totals_batch(counts, np.empty(0, np.int64))

    def count_triples(batches):
        held, size = [], 0
        for batch in sliced(batches, "text"):
            h, at = _tokens(batch.column("text"))
            known, back = np.unique(h, return_inverse=True)
            ids = model.look_up_words(known)[0].astype(np.uint32)[back]
            middle, left = _before(ids, at, model.begin)
            held.append((middle, left, ids))
            size += len(ids)
            if size >= flush_tokens:
                yield from flush_triples(held)
                held, size = [], 0
        if size:
            yield from flush_triples(held)

    def flush_triples(held):
        middle, left, third = (np.concatenate(x) for x in zip(*held))
        context, starts, third, counts = lm_triples.counted(middle, left, third, None)
        middle, left = (context >> U(32)).astype(np.int64), (context & U(0xFFFFFFFF)).astype(np.int64)
        for s, keys, packed in lm_triples.packed(context, starts, third, counts, model.shard_of_pair(middle, left, count_of(middle))):
            yield _record(s, keys, packed)

    def add_triples(batches):
        for s, held in _by_shard(batches):
            parts = [np.concatenate(x) for x in zip(*(lm_triples.unpacked(*r) for r in zip(*held)))]
            held.clear()
            context, starts, third, counts = lm_triples.counted(*parts)
            del parts
            lm_triples.write_triples(model.folder, s, context, starts, third, counts)
            pairs = np.repeat(context & ~U(0xFFFFFFFF), np.diff(starts)) | third.astype(U)
            pairs, before = np.unique(pairs, return_counts=True)
            left, right = (pairs >> U(32)).astype(np.int64), (pairs & U(0xFFFFFFFF)).astype(np.int64)
            left_count = count_of(left)
            hot = model.is_hot(left_count)
            lm_triples.write_pairs(model.folder, "pairs", s, pairs[~hot], before[~hot])
            yield from _around_rows(pairs[~hot], before[~hot], block_bits)
            yield _totals_batch(before[~hot], counts)
            for to, at in _by(model.shard_of_pair(left[hot], right[hot], left_count[hot])):
                yield _record(-2 - to, pairs[hot][at].tobytes(), before[hot][at].astype(np.uint32).tobytes())

    def add_hot(batches):
        for s, held in _by_shard(batches):
            pairs, before = _added(held)
            lm_triples.write_pairs(model.folder, "hot", s, pairs, before)
            yield from _around_rows(pairs, before, block_bits)
            yield _totals_batch(before, np.empty(0, np.int64))

    if order == 2:
        around = written_rows(_dealt(map_arrow(texts, count_pairs, ENCODED), shards).mapInArrow(add_pairs, ENCODED), f"{model.folder}/around-parts")
    else:
        around = written_rows(_dealt(map_arrow(texts, count_triples, ENCODED), shards).mapInArrow(add_triples, ENCODED), f"{model.folder}/around-parts")
        hot = around.where("shard < -1").select((-2 - F.col("shard")).alias("shard"), "keys", "counts")
        hot = written_rows(_dealt(hot, shards).mapInArrow(add_hot, ENCODED), f"{model.folder}/around-hot")
        around = around.where("shard >= -1").unionByName(hot)
    totals = np.zeros(9, np.int64)
    for r in around.where("shard = -1").toLocalIterator():  # a small record or two a shard
        totals += np.frombuffer(r.counts, np.int64)
    model.pair_types, model.discounts, model.triple_discounts = int(totals[0]), _discounts(totals[1:5].tolist()), _discounts(totals[5:].tolist())

    def add_around(batches):
        for b, held in _by_shard(batches):
            out = np.zeros((model.block_size(b), 5), np.int64)
            for keys, counts in zip(*held):
                out_at = np.frombuffer(keys, np.uint32)
                out[out_at] += lm_triples.unplaned(counts, np.int64).reshape(5, -1).T  # ids don't repeat within a record
            write_file(f"{model.folder}/around-{b}", lm_triples.narrowest(out.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([int((out[:, 3] == k).sum())], pa.int64()) for k in (1, 2, 3, 4)],
                                             names=["n1", "n2", "n3", "n4"])

    blocks = (model.words >> block_bits) + 1
    seen = _dealt(around.where("shard >= 0"), blocks).mapInArrow(add_around, "n1 long, n2 long, n3 long, n4 long")
    n = seen.agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4")]).first()
    n = [float(x or 0) for x in n]
    model.unigram_discounts = d = _discounts(n)
    if model.pair_types:
        model.unigram_mass = float(d[1] * n[0] + d[2] * n[1] + d[3] * (model.words - n[0] - n[1])) / model.pair_types
    return model


def written_rows(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _record(shard: int, keys: bytes, counts: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([keys], pa.binary()), pa.array([counts], pa.binary())],
                                      names=["shard", "keys", "counts"])


def _totals_batch(pairs: np.ndarray, triples: np.ndarray) -> pa.RecordBatch:
    """The number of pairs, and how many pairs and triples have a count of 1 to 4."""
    totals = [len(pairs), *[(x == k).sum() for x in (pairs, triples) for k in (1, 2, 3, 4)]]
    return _record(-1, b"", np.array(totals, np.int64).tobytes())


def _before(words: np.ndarray, at: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before each word and the one before that; ``begin`` beyond a text's first word."""
    one, two = np.empty_like(words), np.empty_like(words)
    one[1:], two[2:] = words[:-1], words[:-2]
    one[at[:-1]] = two[at[:-1]] = begin
    second = at[:-1] + 1
    two[second[second < len(words)]] = begin
    return one, two


def _around_rows(keys: np.ndarray, counts: np.ndarray, block_bits: int) -> Iterator[pa.RecordBatch]:
    """What a shard's pairs add to the words around: for each block of ids the ids with
    (followers seen once, twice, more often; predecessors; the followers' counts in all)."""
    left, right = (keys >> U(32)).astype(np.int64), (keys & U(0xFFFFFFFF)).astype(np.int64)
    ids, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    out = np.zeros((len(ids), 5), np.int64)
    for k in range(3):
        here = counts >= 3 if k == 2 else counts == k + 1
        out[:, k] = np.bincount(at[:len(left)][here], minlength=len(ids))
    out[:, 3] = np.bincount(at[len(left):], minlength=len(ids))
    out[:, 4] = np.bincount(at[:len(left)], weights=counts, minlength=len(ids))
    blocks = ids >> block_bits
    for b in np.unique(blocks):
        a, z = np.searchsorted(blocks, [b, b + 1])
        yield _record(int(b), (ids[a:z] - (b << block_bits)).astype(np.uint32).tobytes(), lm_triples.planes(out[a:z].T.ravel()))


def score_texts(model: Model, column: pa.Array) -> dict[str, np.ndarray]:
    """n_tokens, n_known, base_score and score of each text."""
    h, at = _tokens(column)
    kinds, back = np.unique(h, return_inverse=True)
    ids, counts = model.look_up_words(kinds)
    n_words, total = model.words, model.tokens
    base = np.log10((counts + 1) / (total + n_words + 1))
    # lower order: continuation counts, interpolated with the uniform distribution over all words and the unknown one
    known = np.flatnonzero(ids >= 0)
    around = np.zeros((len(ids) + 1, 5), np.int64)  # the last row is the text's beginning
    order = known[np.argsort(ids[known], kind="stable")]
    around[order] = model.around(ids[order])
    lower, back_off = np.full(len(ids), 1.0 / (n_words + 1)), np.ones(len(ids) + 1)
    if model.pair_types:
        d = model.unigram_discounts
        before = around[:-1, 3]
        lower = (before - d[np.minimum(before, 3)]) / model.pair_types + model.unigram_mass / (n_words + 1)
        around[-1] = model.around(np.array([model.begin]))[0]
        context = around[:, 4]
        spare = around[:, :3] @ model.discounts[1:]
        back_off = np.where(context > 0, spare / np.maximum(context, 1), 1.0)
    left, left2 = _before(back, at, len(kinds))
    pairs, pair_of = np.unique(left.astype(np.int64) * (len(kinds) + 1) + back, return_inverse=True)
    a, b = pairs // (len(kinds) + 1), pairs % (len(kinds) + 1)
    p = back_off[a] * lower[b]
    if model.pair_types:
        left_ids, left_counts = np.append(ids, model.begin)[a], np.append(counts, model.texts)[a]
        seen = np.flatnonzero((left_ids >= 0) & (ids[b] >= 0))
        c = model.pair_counts(left_ids[seen], ids[b][seen], left_counts[seen])
        p[seen] += np.where(c > 0, (c - model.discounts[np.minimum(c, 3)]) / np.maximum(context[a][seen], 1), 0.0)
        if model.order == 3:
            known_ids = np.append(ids, model.begin)
            kinds_of, pair_back = np.unique(left2.astype(np.int64) * len(pairs) + pair_of, return_inverse=True)
            before, pair = kinds_of // len(pairs), kinds_of % len(pairs)
            p, pair_of = p[pair], pair_back
            seen = np.flatnonzero((known_ids[before] >= 0) & (left_ids[pair] >= 0))
            mid = pair[seen]
            c, sums = model.triples(known_ids[before[seen]], left_ids[mid], ids[b][mid], left_counts[mid])
            d, total = model.triple_discounts, np.maximum(sums[:, 0], 1)
            p[seen] = np.where(sums[:, 0] > 0, (c - d[np.minimum(c, 3)] + (sums[:, 1:] @ d[1:]) * p[seen]) / total, p[seen])
    n = np.diff(at)
    text = np.repeat(np.arange(len(n)), n)
    add = lambda x: np.bincount(text, weights=x, minlength=len(n))
    return {"n_tokens": n, "n_known": add((counts > 0)[back]).astype(np.int64), "base_score": add(base[back]), "score": add(np.log10(p)[pair_of])}


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in sliced(batches, "text"):
            s = score_texts(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(s["n_tokens"], pa.int64()), pa.array(s["n_known"]),
                 pa.array(np.full(batch.num_rows, model.tokens, np.int64)), pa.array(s["base_score"]), pa.array(s["score"]),
                 pa.array(10 ** (-s["score"] / s["n_tokens"]))],
                names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    d = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    return map_arrow(d, run, f"id {key}, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
                             "perplexity double").withColumnRenamed("id", id_col)
