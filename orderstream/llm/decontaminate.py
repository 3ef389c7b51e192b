"""Benchmark decontamination (operator 8): Wu-Manber multi-pattern search.

The alphabet is words: runs of ASCII letters and digits and of characters beyond
ASCII, with A-Z in lower case. The patterns are all windows of ``window``
consecutive words of the benchmark items; an item of fewer words, but not none,
is one window. For all windows of one length m, a block is the last ``BLOCK`` words of
the text under the window: the shift table tells how far the window may move, an
unknown block moves it m - BLOCK + 1 words. At shift 0 the bucket of the block's
hash gives the windows that end so, and comparing the words decides.

The benchmark is a stated set of queries: it is brought to the workers in blocks
of at most ``block_chars`` characters, each block a pass over the documents, so a
larger benchmark means more passes and not more memory. Only where there are several the different texts are
dealt out once and written, so that the passes' rows can be put together.

Defined cases: null or empty texts have no words and no hits; a text of any
length is read in pieces that overlap by a window; items with a null or empty text have no
window; an item without id still marks words but isn't listed; repeated items and
repeated rows are each treated alike; without any item nothing is contaminated.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, text_or_empty, written

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BLOCK = 3
PIECE = 4 << 20
#: Characters of the benchmark that a pass compiles: tables of about 140 bytes each, so some 400 MB in a worker at most.
BLOCK_CHARS = 3_000_000


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes, cut where no word is."""
    at = 0
    gap = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
    while len(text) - at > size:
        m = gap.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


class WuManber:
    """All patterns are lists of ``m`` words, given with the items they are from."""

    def __init__(self, m: int, patterns: dict[tuple, set]):
        self.m, self.b = m, min(BLOCK, m)
        self.far = m - self.b + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list] = {}
        for p, items in patterns.items():
            for end in range(self.b, m + 1):
                block = p[end - self.b:end]
                d = m - end
                if d < self.shift.get(block, self.far):
                    self.shift[block] = d
            self.bucket.setdefault(p[m - self.b:], []).append((list(p), items))

    def search(self, words: list[bytes], first_end: int) -> Iterator[tuple[int, set]]:
        """(start, items) of each occurrence that ends at word ``first_end`` or later."""
        m, b, far, n = self.m, self.b, self.far, len(words)
        shift, bucket = self.shift.get, self.bucket
        i = max(m, first_end + 1)  # one past the window's last word
        if b == 3:
            while i <= n:
                block = (words[i - 3], words[i - 2], words[i - 1])
                d = shift(block, far)
                if d:
                    i += d
                    continue
                at = words[i - m:i]
                for p, items in bucket[block]:
                    if p == at:
                        yield i - m, items
                        break
                i += 1
            return
        while i <= n:
            block = tuple(words[i - b:i])
            d = shift(block, far)
            if d:
                i += d
                continue
            at = words[i - m:i]
            for p, items in bucket[block]:
                if p == at:
                    yield i - m, items
                    break
            i += 1


def compile_items(items: list[tuple[str | None, bytes]], window: int) -> list[WuManber]:
    by_length: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        w = words_of(text)
        m = min(window, len(w))
        if m:
            found = by_length.setdefault(m, {})
            for i in range(len(w) - m + 1):
                found.setdefault(tuple(w[i:i + m]), set()).add(item)
    return [WuManber(m, found) for m, found in sorted(by_length.items())]


def scan(text: bytes, searchers: list[WuManber], window: int, piece: int = PIECE, only_first: bool = False) -> tuple[int, list, set]:
    """Number of words, merged hit ranges in words (end exclusive), item ids; with
    ``only_first`` as far as the first occurrence."""
    ranges: list[tuple[int, int]] = []
    found: set = set()
    tail: list[bytes] = []
    total = 0
    for part in pieces(text, piece):
        words = words_of(part)
        total += len(words)
        fresh = len(tail)  # words[fresh:] weren't the end of a window before
        words = tail + words
        base = total - len(words)
        for s in searchers:
            for start, items in s.search(words, fresh):
                ranges.append((base + start, base + start + s.m))
                found |= items
                if only_first:
                    return total, ranges, found
        tail = words[-(window - 1):] if window > 1 else []
    merged: list[list[int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    found.discard(None)
    return total, merged, found


def _pass(items, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = compile_items(items.value, window)
        for batch in batches:
            ids, n, hits, names = [], [], [], []
            for text in batch.column("text"):
                total, ranges, found = scan(text.as_py() or b"", searchers, window)
                n.append(total)
                hits.append([{"start": a, "end": b} for a, b in ranges])
                names.append(sorted(found))
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(n, pa.int64()), pa.array(hits, pa.list_(span)), pa.array(names, pa.list_(pa.string()))],
                names=["key", "n_words", "hits", "items"])
    return run


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_chars: int) -> Iterator[list]:
    """The items in lists of about ``block_chars`` characters."""
    b = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), text_or_empty(item_text).cast("binary").alias("text"))
    block, size = [], 0
    for row in b.toLocalIterator():
        if block and size + len(row.text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row.item, bytes(row.text)))
        size += len(row.text)
    yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = 10,
                       block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document: id, n_words, hits (merged ranges of word
    positions, end exclusive), items (ids of the items found, sorted)."""
    spark = docs.sparkSession
    key = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(f"`{id_col}`").alias("key"), text_or_empty(text_col).cast("binary").alias("text"))
    schema = f"key {key}, n_words long, hits array<struct<start:bigint,end:bigint>>, items array<string>"
    blocks = _blocks(benchmark, item_id, item_text, block_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return map_arrow(d, _pass(spark.sparkContext.broadcast(first), window), schema).withColumnRenamed("key", id_col)
    # One row a block and document: written, then put together by document. Rows
    # that repeat an id are told apart by their text's digest and counted back.
    times = d.select("key", F.sha2("text", 256).alias("sha")).groupBy("key", "sha").agg(F.count(F.lit(1)).alias("times"))
    parts = None
    once = written(spark, d.withColumn("sha", F.sha2("text", 256)).dropDuplicates(["key", "sha"]), "leak-texts")
    marked = once.select(F.struct("key", "sha").alias("key"), "text")
    for items in itertools.chain([first, second], blocks):
        run = map_arrow(marked, _pass(spark.sparkContext.broadcast(items), window),
                        schema.replace(f"key {key}", f"key struct<key:{key},sha:string>", 1))
        part = written(spark, run.select("key.key", "key.sha", "n_words", "hits", "items"), "leak-pass")
        parts = part if parts is None else parts.unionByName(part)
    merged = (parts.groupBy("key", "sha").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("hits"))).alias("all_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    joined = merged.join(times, (merged["key"].eqNullSafe(times["key"])) & (merged["sha"] == times["sha"])) \
        .select(merged["key"], "n_words", _merge_ranges("all_hits").alias("hits"), "items", "times")
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))) \
        .select(F.col("key").alias(id_col), "n_words", "hits", "items")


def _merge_ranges(column: str):
    """Sorted ranges with those that touch made one."""
    return F.expr(f"""aggregate({column}, cast(array() as array<struct<start:bigint,end:bigint>>), (acc, x) ->
        CASE WHEN size(acc) > 0 AND x.start <= element_at(acc, -1).end
             THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end))))
             ELSE concat(acc, array(named_struct('start', x.start, 'end', x.end))) END)""")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", window: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without any occurrence, all their columns as they were."""
    spark = docs.sparkSession
    schema, done = docs.schema, 0
    for items in _blocks(benchmark, item_id, item_text, block_chars):
        if done:
            docs = written(spark, docs, "leak-filter")
        items, done = spark.sparkContext.broadcast(items), done + 1

        def run(batches, items=items):
            searchers = compile_items(items.value, window)
            for batch in batches:
                clean = [not scan((t.as_py() or "").encode(), searchers, window, only_first=True)[1] for t in batch.column(text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = map_arrow(docs, run, schema)
    return docs
