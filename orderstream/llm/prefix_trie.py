"""Operator 13: the prefix trie of conversations.

A turn is known by 128 bits of the SHA-256 of its role and text, a conversation by its
turns' digests in a row (its path). Conversations are sorted by path over
all tasks; a task cuts its range into shards of a bounded number of turns. In a shard the
digests become numbers of a dictionary in digest order, and a ternary search
tree takes the distinct sequences, medians first, so that the search trees of siblings are
balanced. An iterative walk adds up members, childless nodes and savings from below.

Only the nodes on the path of a shard's first and last conversation can have members in
other shards. They leave the shard as partial sums, in path order, and one pass over all
shards' boundary nodes (their number follows the shards, not the conversations) merges them with a
stack. Texts are never shuffled; a path has 16 bytes a turn.

Defined cases: null role or text counts as empty; turns are ordered by ``turn`` (null first),
equal ones by the digest of role and text, and repeated rows are turns of their own. Rows
without ``conv_id`` take no part. A conversation of any length is one row of digests. An
empty table has no nodes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, written

DIGEST = 16
#: Turns of a shard, unless one conversation has more.
SHARD_TURNS = 200_000
#: A group of children without a common task: rows that look their parent up meet it in so many places.
SALTS = 32

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
_PART = (f"kind string, shard long, place long, key binary, parent_key binary, size long, ends string, {NODE}")


def turn_lists(conversations: DataFrame, by=None) -> DataFrame:
    """``conv_id, by, turns``: each conversation's (digest, bytes of the text) in order; conversations of one ``by``
    (an expression of ``conv_id``, the id itself by default) are in one partition."""
    conv = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"), F.col("turn").alias("turn"),
        F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    rows = rows.withColumn("by", F.col("conv_id") if by is None else by).repartition("by")
    turns = F.sort_array(F.collect_list(F.struct("turn", "digest", "bytes")))
    return rows.groupBy("by", "conv_id").agg(F.transform(turns, lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path, sizes`` of conversations as lists of turns: digests in a row, bytes of each text."""
    return turns.select("conv_id", F.unhex(F.array_join(F.col("turns.digest"), "")).alias("path"), F.col("turns.bytes").alias("sizes"))


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """The conversations as they are."""
    return paths(turn_lists(conversations))


def rebuilt_paths(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """The conversations rebuilt: c takes its first h turns from conversation c - c % ``family`` (fewer if that
    has fewer, none if it is absent) and the rest, after its own first h, from itself; h = crc32(c as text) % ``heads``."""
    lists = turn_lists(conversations, F.col("conv_id") - F.col("conv_id") % family)
    first = F.max(F.when(F.col("conv_id") == F.col("by"), F.slice("turns", 1, heads - 1))).over(Window.partitionBy("by"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    none = F.array().cast("array<struct<digest:string,bytes:bigint>>")
    head = F.when(h > 0, F.slice(F.coalesce("first", none), F.lit(1), h)).otherwise(none)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return paths(lists.withColumn("first", first).select("conv_id", F.concat(head, rest).alias("turns")))


class TernaryTree:
    """A ternary search tree over sequences of integers. Node 0 is the root, which stands for the empty
    sequence; ``equal`` leads to the search tree of a node's children, ``low`` and ``high`` to siblings."""

    def __init__(self):
        self.symbol, self.low, self.equal, self.high, self.size = [-1], [-1], [-1], [-1], [0]

    def insert(self, sequence: list[int], sizes: list[int]) -> int:
        """The node of ``sequence``; the nodes that it lacks are made."""
        node, symbol = 0, self.symbol
        for s, size in zip(sequence, sizes, strict=True):
            links, owner = self.equal, node
            node = links[owner]
            while node >= 0 and symbol[node] != s:
                links, owner = self.low if s < symbol[node] else self.high, node
                node = links[owner]
            if node < 0:
                node = links[owner] = len(symbol)
                for column, value in ((symbol, s), (self.low, -1), (self.equal, -1), (self.high, -1), (self.size, size)):
                    column.append(value)
        return node

    def chain(self, sequence: list[int]) -> list[int]:
        """The nodes of all prefixes of a sequence that is in the tree, the root first."""
        out = [0]
        for s in sequence:
            node = self.equal[out[-1]]
            while self.symbol[node] != s:
                node = self.low[node] if s < self.symbol[node] else self.high[node]
            out.append(node)
        return out

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, parent, depth), parents first, siblings in order of their symbols; without recursion."""
        stack = [(0, -1, 0, True)]
        while stack:
            node, parent, depth, reached = stack.pop()
            if reached:
                yield node, parent, depth
                if self.equal[node] >= 0:
                    stack.append((self.equal[node], node, depth + 1, False))
                continue
            if self.high[node] >= 0:
                stack.append((self.high[node], parent, depth, False))
            stack.append((node, parent, depth, True))
            if self.low[node] >= 0:
                stack.append((self.low[node], parent, depth, False))


def medians(n: int) -> Iterator[int]:
    """0 .. n-1, the middle of every range before its halves."""
    stack = [(0, n)]
    while stack:
        low, high = stack.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            stack += [(mid + 1, high), (low, mid)]


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


NO_ENDS = _sha("")


def shard_nodes(shard: int, ids: np.ndarray, keys: list[bytes], sizes: list[list[int]]) -> Iterator[tuple]:
    """The rows (columns of ``_PART``) of a shard: conversations sorted by path and id."""
    starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    ends = [*starts[1:], len(keys)]
    coded = np.unique(np.frombuffer(b"".join(keys[i] for i in starts), f"S{DIGEST}"), return_inverse=True)[1].tolist()
    sequences, at = [], 0
    for i in starts:
        n = len(keys[i]) // DIGEST
        sequences.append(coded[at:at + n])
        at += n
    tree, ended = TernaryTree(), {}
    for k in medians(len(starts)):
        ended[tree.insert(sequences[k], sizes[starts[k]])] = k
    n = len(tree.symbol)
    count, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for node, k in ended.items():
        count[node], least[node] = ends[k] - starts[k], int(ids[starts[k]:ends[k]].min())
    first, last = tree.chain(sequences[0]), tree.chain(sequences[-1])
    key_of = {node: hashlib.sha256(path[:d * DIGEST]).digest()[:DIGEST]
              for chain, path in ((first, keys[0]), (last, keys[-1])) for d, node in enumerate(chain)}
    walked = list(tree.walk())
    for node, parent, _ in reversed(walked):
        if node not in key_of:
            leaves[node] = leaves[node] or 1
            saved[node] += (count[node] - 1) * tree.size[node]
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
        if parent >= 0:
            count[parent] += count[node]
            least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
    for place, (node, parent, depth) in enumerate(walked):
        k = ended.get(node)
        text = "" if k is None else _joined(ids[starts[k]:ends[k]])
        sums = (count[node], children[node], leaves[node], saved[node])
        if node in key_of:
            yield ("open", shard, place, key_of[node], key_of.get(parent), tree.size[node], text,
                   least[node], depth, None, *sums, None)
        else:
            above = key_of.get(parent)
            yield ("node", shard, None, None, above, None, None, least[node], depth, least[parent] if above is None else None,
                   *sums, _sha(text) if text else NO_ENDS)


def _batches(rows: Iterator[tuple], schema: pa.Schema, n: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == n:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _shards(shard_turns: int):
    schema = _arrow(_PART)

    def run(batches):
        task, n = TaskContext.get().partitionId(), 0

        def rows():
            nonlocal n
            ids, keys, sizes, turns = [], [], [], 0
            for batch in batches:
                for i, path, s in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "sizes")), strict=True):
                    if turns and turns + len(s) + 1 > shard_turns:
                        yield from shard_nodes(task << 32 | n, np.array(ids), keys, sizes)
                        ids, keys, sizes, turns, n = [], [], [], 0, n + 1
                    ids.append(i)
                    keys.append(path)
                    sizes.append(s)
                    turns += len(s) + 1
            if ids:
                yield from shard_nodes(task << 32 | n, np.array(ids), keys, sizes)

        yield from _batches(rows(), schema)

    return run


def merge_boundaries(rows: Iterator[dict]) -> Iterator[tuple]:
    """Boundary nodes of all shards, in order of shard and place, to (key, parent key, columns of ``NODE`` with
    ``parent_conv_id`` empty). The stack holds the last conversation's path so far; a node that the next
    path doesn't have is complete."""
    stack: list[dict] = []

    def close() -> tuple:
        x = stack.pop()
        leaves, saved = x["n_leaves"] or 1, x["saved_tokens"] + (x["n_convs"] - 1) * x["size"]
        if stack:
            above = stack[-1]
            above["n_children"] += 1
            above["n_leaves"] += leaves
            above["saved_tokens"] += saved
        return (x["key"], stack[-1]["key"] if stack else None, x["conv_id"], x["depth"], None, x["n_convs"], x["n_children"],
                leaves, saved, x["sha"].hexdigest())

    for row in rows:
        depth = row["depth"]
        if len(stack) > depth and stack[depth]["key"] != row["key"]:
            while len(stack) > depth:
                yield close()
        if len(stack) > depth:
            x = stack[depth]
            for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                x[c] += row[c]
            x["conv_id"] = min(x["conv_id"], row["conv_id"])
        else:
            x = {**row, "sha": hashlib.sha256(), "any": False}
            stack.append(x)
        if row["ends"]:
            x["sha"].update((("," if x["any"] else "") + row["ends"]).encode())
            x["any"] = True
    while stack:
        yield close()


def _merge(batches):
    schema = _arrow(f"key binary, parent_key binary, {NODE}")
    yield from _batches(merge_boundaries(row for batch in batches for row in batch.to_pylist()), schema)


def trie_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row (columns of ``NODE``) for each distinct prefix of the sequences in ``conv_id, path, sizes``; ids are unique."""
    spark = sequences.sparkSession
    dealt = written(spark, sequences, "trie-paths").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = written(spark, map_arrow(dealt, _shards(shard_turns), _PART), "trie-parts")
    opens = parts.where("kind = 'open'").select("shard", "place", "key", "size", "ends", *[c.split()[0] for c in NODE.split(", ")])
    ordered = opens.repartition(1).sortWithinPartitions("shard", "place")
    merged = written(spark, map_arrow(ordered, _merge, f"key binary, parent_key binary, {NODE}"), "trie-boundaries")
    names = [c.split()[0] for c in NODE.split(", ")]
    closed = parts.where("kind = 'node'").select("parent_key", *names)
    inner = closed.where("parent_key IS NULL").select(*names)
    # a boundary node such as the root can be the parent of most nodes: its children look it up in salted places
    waiting = closed.where("parent_key IS NOT NULL").unionByName(merged.where("parent_key IS NOT NULL").select("parent_key", *names))
    waiting = waiting.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    resolved = waiting.drop("parent_conv_id").join(parents, ["parent_key", "salt"]).withColumnRenamed("found", "parent_conv_id").select(*names)
    return inner.unionByName(resolved).unionByName(merged.where("parent_key IS NULL").select(*names))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie_nodes(conversation_paths(conversations))
