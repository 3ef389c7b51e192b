"""BPE encoding and decoding (operator 9) by forced-boundary splitting.

A word's symbols are its bytes, the last one with the word-end mark. Two symbols
that stand side by side nowhere inside any vocabulary token can never end up in
one token, whatever is merged: between them is a certain cut. A word falls into
fragments at its cuts; each fragment is merged on its own (lowest rank first,
leftmost among equals) and the ids are put together in order. Fragments repeat far more
than words do, so both are remembered by a worker, up to a bound.

Normalisation and word splitting are those of the tokenizer file: NFC, lower case
character by character, then contractions, runs of letters, single numerals and runs of other
characters; white space separates and is dropped. Strings of special tokens in a
text become their ids. Decoding joins the tokens' strings with a space, as a file
without decoder asks for.

Defined cases: a null text counts as empty; an empty or all-blank text has no
tokens and decodes to the empty string; texts are encoded whole at any length;
repeated rows are each encoded; other columns are never read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import map_arrow, text_or_empty

MARK = "</w>"
#: White space of the Unicode standard; letters and numerals up to U+024F.
SPACE = "\\t-\\r \x85\xa0  -     　"
LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMERAL = "0-9\xb2\xb3\xb9\xbc-\xbe"
CONTRACTION = "'(?:s|t|re|ve|m|ll|d)"
NARROW = re.compile(f"[{LETTER}]+|{CONTRACTION}|[{NUMERAL}]|[^{SPACE}{LETTER}{NUMERAL}]+")
BEYOND = re.compile("[^\x00-ɏ]")
SHORT = 48  # symbols of a fragment for which single merges are the faster way
LONG = 256  # symbols of words and fragments that aren't remembered: they hardly come again


@lru_cache(maxsize=1)
def wide_pattern():
    """The word pattern for all of Unicode, by the version of Unicode that Python
    itself has: characters that are newer count as unassigned, neither letter nor numeral."""
    unassigned = "".join(chr(c) for c in range(0x250, 0x110000) if unicodedata.category(chr(c)) == "Cn")
    newer = "".join(regex.findall(r"[\p{L}\p{N}]", unassigned))
    letter, numeral = (rf"[\p{{{x}}}--[{newer}]]" if newer else rf"\p{{{x}}}" for x in "LN")
    other = rf"[[^{SPACE}\p{{L}}\p{{N}}]||[{newer}]]" if newer else rf"[^{SPACE}\p{{L}}\p{{N}}]"
    return regex.compile(f"{letter}+|{CONTRACTION}|{numeral}|{other}+", regex.V1)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in plain:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b] = chr(extra)
            extra += 1
    return out


class Remembered(dict):
    """What ``make`` gives for a key; forgets everything beyond ``most`` keys, and keeps no long ones."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONG:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int], remember: int = 200_000):
        self.vocab = vocab
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.special = special
        self.letters = byte_letters()
        self.id_of = {t: str(i) for t, i in vocab.items()}
        self.inside = {pair for t in vocab for s in [self.symbols(t)] for pair in zip(s, s[1:])}
        self.token_of = {str(i): t for t, i in [*vocab.items(), *special.items()]}
        self.fragments = Remembered(self.merge, remember // 4)
        self.words = Remembered(self.word, remember)
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        starts = {t[:2] for t in special}  # a quick look for what special tokens begin with
        self.mark_special = re.compile("|".join(map(re.escape, sorted(starts)))) if special else None

    @staticmethod
    def symbols(token: str) -> tuple[str, ...]:
        if token.endswith(MARK) and len(token) > len(MARK):
            body = token[:-len(MARK)]
            return (*body[:-1], body[-1] + MARK)
        return tuple(token)

    def merge(self, fragment: Sequence[str]) -> str:
        """Ids of one fragment, joined by a space."""
        parts, ranks = list(fragment), self.ranks
        none = len(ranks)
        if len(parts) <= SHORT:  # one merge at a time; only the ranks beside it change
            rank_of = ranks.get
            rank = [rank_of(p, none) for p in zip(parts, parts[1:])]
            while rank:
                best = min(rank)
                if best == none:
                    break
                i = rank.index(best)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del rank[i]
                if i:
                    rank[i - 1] = rank_of((parts[i - 1], parts[i]), none)
                if i < len(rank):
                    rank[i] = rank_of((parts[i], parts[i + 1]), none)
            return " ".join([self.id_of[p] for p in parts])
        return " ".join([self.id_of[p] for p in self._merge_long(parts)])

    def _merge_long(self, parts: list) -> list[str]:
        """The same merges by a heap of (rank, place) over linked symbols: n log n for a fragment of n."""
        n, rank_of = len(parts), self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or rank_of((parts[i], parts[j])) != rank:
                continue  # something merged here meanwhile
            parts[i] += parts[j]
            parts[j], k = None, after[j]
            after[i] = k
            if k < n:
                before[k] = i
                if (r := rank_of((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank_of((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return [p for p in parts if p is not None]

    def cut(self, symbols: list[str]) -> list[tuple[str, ...]]:
        inside, out, start = self.inside, [], 0
        for i in range(1, len(symbols)):
            if (symbols[i - 1], symbols[i]) not in inside:
                out.append(tuple(symbols[start:i]))
                start = i
        out.append(tuple(symbols[start:]))
        return out

    def word(self, word: str) -> str:
        s = [self.letters[b] for b in word.encode("utf-8", "replace")]
        s[-1] += MARK
        if self.inside.issuperset(zip(s, s[1:])):  # no cut, as in most words
            return self.merge(s)
        return " ".join([self.fragments[f] for f in self.cut(s)])

    def words_of(self, text: str) -> list[str]:
        """The normalised words of a text without special tokens."""
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower case goes by single characters
        text = text.lower()
        return (wide_pattern() if BEYOND.search(text) else NARROW).findall(text)

    def plain(self, text: str) -> list[str]:
        """Ids of each word of a text without special tokens."""
        words = self.words
        return [words[w] for w in self.words_of(text)]

    def encode(self, text: str) -> str:
        """The ids as decimal numbers, joined by one space."""
        if self.split_special is None or not self.mark_special.search(text):
            return " ".join(self.plain(text))
        out: list[str] = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(str(self.special[part]))
            elif part:
                out.extend(self.plain(part))
        return " ".join(out)

    def decode(self, ids: str) -> str:
        return " ".join(map(self.token_of.__getitem__, ids.split(" "))) if ids else ""


def read_encoder(tokenizer: str) -> Encoder:
    """The encoder of a tokenizer file's content."""
    j = json.loads(tokenizer)
    merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in j["model"]["merges"]]
    return Encoder(j["model"]["vocab"], merges, {t["content"]: t["id"] for t in j["added_tokens"]})


@lru_cache(maxsize=2)
def _cached(tokenizer: str) -> Encoder:
    return read_encoder(tokenizer)


def _encode_pass(tokenizer, output):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _cached(tokenizer.value)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column("text"))
            yield output(encoder, batch.column("key"), texts)
    return run


def _digest_batch(encoder: Encoder, keys, texts) -> pa.RecordBatch:
    n, ids, decoded = [], [], []
    for t in texts:
        e = encoder.encode(t)
        n.append(e.count(" ") + 1 if e else 0)
        ids.append(hashlib.sha256(e.encode()).hexdigest())
        decoded.append(hashlib.sha256(encoder.decode(e).encode()).hexdigest())
    return pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                                      names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])


def _full_batch(encoder: Encoder, keys, texts) -> pa.RecordBatch:
    ids, decoded = [], []
    for t in texts:
        e = encoder.encode(t)
        ids.append([int(x) for x in e.split(" ")] if e else [])
        decoded.append(encoder.decode(e))
    return pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                                      names=["key", "ids", "decoded"])


def _apply(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, columns: str, output) -> DataFrame:
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())  # a vocabulary: its size doesn't grow with the data
    d = docs.select(F.col(f"`{id_col}`").alias("key"), text_or_empty(text_col).alias("text"))
    key = docs.schema[id_col].dataType.simpleString()
    return map_arrow(d, _encode_pass(content, output), f"key {key}, {columns}").withColumnRenamed("key", id_col)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int), decoded (string)."""
    return _apply(docs, tokenizer_path, id_col, text_col, "ids array<int>, decoded string", _full_batch)


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: what ``encode`` gives, digested
    where it is made, so the ids themselves needn't travel."""
    return _apply(docs, tokenizer_path, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digest_batch)
