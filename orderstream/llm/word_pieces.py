"""Token counts (operator 6): greedy word pieces by a linear longest-match automaton.

The vocabulary's trie is read one symbol at a time. A node's failure link says
where to go on when no child fits: popping the longest matching pieces off the
node's string leaves the link's string. How many pieces that pops is computed
with the link, so a word's greedy longest-match length is a sum of counts along
its walk: no piece is built and no symbol is read twice.

Words are those of ``llm.bpe``; a word's symbols are its bytes, the last one with
the word-end mark, and each symbol is a piece by itself, so every word has pieces.

Defined cases: null, empty and blank texts have no words and no pieces; strings
of special tokens are one piece each; texts are counted whole; repeated rows are
counted each; other columns are never read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.bpe import MARK, Encoder, Remembered
from orderstream.llm.common import map_arrow, text_or_empty


class Automaton:
    """Nodes are numbers, the root 0. ``pops``: pieces that following the failure link
    pops; ``ends``: pieces left when a word ends at the node."""

    def __init__(self, pieces: Iterable[tuple]):
        self.children: list[dict] = [{}]
        whole = [False]
        for piece in pieces:
            v = 0
            for c in piece:
                nxt = self.children[v].get(c)
                if nxt is None:
                    nxt = self.children[v][c] = len(self.children)
                    self.children.append({})
                    whole.append(False)
                v = nxt
            whole[v] = True
        n = len(self.children)
        self.fail, self.pops, self.ends = [-1] * n, [0] * n, [0] * n
        level = [0]
        while level:
            below = []
            for u in level:
                for c, v in self.children[u].items():
                    below.append(v)
                    if whole[v]:
                        self.fail[v], self.pops[v] = 0, 1
                    else:
                        z, popped = self.fail[u], self.pops[u]
                        while z >= 0 and c not in self.children[z]:
                            popped += self.pops[z]
                            z = self.fail[z]
                        self.fail[v], self.pops[v] = (self.children[z][c], popped) if z >= 0 else (-1, 0)
                    f = self.fail[v]
                    self.ends[v] = self.pops[v] + self.ends[f] if f >= 0 and self.ends[f] >= 0 else -1
            level = below

    def count(self, symbols: Iterable) -> int:
        """Greedy longest-match pieces of one word; -1 if it has no such division."""
        children, fail, pops, v, n = self.children, self.fail, self.pops, 0, 0
        for c in symbols:
            while c not in children[v]:
                n += pops[v]
                v = fail[v]
                if v < 0:
                    return -1
            v = children[v][c]
        return n + self.ends[v] if self.ends[v] >= 0 else -1


class Counter:
    def __init__(self, tokenizer: str, remember: int = 500_000):
        j = json.loads(tokenizer)
        self.reader = Encoder(j["model"]["vocab"], [], {t["content"]: t["id"] for t in j["added_tokens"]})
        self.automaton = Automaton(Encoder.symbols(t) for t in j["model"]["vocab"])
        self.of = Remembered(self.word, remember)

    def word(self, word: str) -> int:
        s = [self.reader.letters[b] for b in word.encode("utf-8", "replace")]
        s[-1] += MARK
        return self.automaton.count(s)

    def count(self, text: str) -> tuple[int, int]:
        """(words, pieces)."""
        parts = self.reader.split_special.split(text) if self.reader.split_special is not None and "<|" in text else [text]
        words = pieces = 0
        for part in parts:
            if part in self.reader.special:
                words, pieces = words + 1, pieces + 1
            elif part:
                found = self.reader.words_of(part)
                words += len(found)
                pieces += sum(map(self.of.__getitem__, found))
        return words, pieces


@lru_cache(maxsize=2)
def _cached(tokenizer: str) -> Counter:
    return Counter(tokenizer)


def count_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) of every row."""
    with open(tokenizer_path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: its size doesn't grow with the data

    def run(batches):
        counter = _cached(content.value)
        for batch in batches:
            n = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([w for w, _ in n], pa.int64()), pa.array([p for _, p in n], pa.int64())],
                                             names=["id", "n_words", "n_tokens"])

    key = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    return map_arrow(d, run, f"id {key}, n_words long, n_tokens long").withColumnRenamed("id", id_col)
