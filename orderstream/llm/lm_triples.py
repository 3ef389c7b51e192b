"""Word triples of the language model (operator 5, order 3): counts, and the pairs that follow from them.

Triples are dealt to shards by their middle word, so that a shard has all it needs at once: the triples
that follow a pair (left, middle), and for each pair (middle, third) the number of different words before it. A middle word
with more than its share of all tokens is split by the left word; its pairs are added up in a
second, small pass.

A shard's arrays are prefix-coded: a list of middle words, for each the sorted left words, for each
of these the sorted third words with counts. A prefix is stored once, so a triple takes four bytes and its count, and a
search is a binary search among the words after the same prefix. What is asked of a whole
context, its total and how many followers it has once, twice and more often, is added up from
its counts; for contexts with many followers it is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from orderstream.llm.common import shared_arrays, write_file
from orderstream.llm.words import U

#: Contexts with more different followers than this have their sums stored.
LONG = 64
LOW = U(0xFFFFFFFF)


def planes(x: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second bytes and so on: those that are zero pack well."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def unplaned(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def narrowest(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0)).tobytes()


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted keys."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def counted(middle: np.ndarray, left: np.ndarray, third: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context keys middle << 32 | left, first triple of each with the end, third words, counts), all sorted."""
    context, rank = np.unique(middle.astype(U) << U(32) | left.astype(U), return_inverse=True)
    key = rank.astype(U) << U(32) | third.astype(U)
    del rank
    if counts is None:
        key.sort()
        at = firsts(key)
        counts = np.diff(at, append=len(key))
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = firsts(key)
        counts = np.add.reduceat(counts[order].astype(np.int64), at) if len(at) else np.empty(0, np.int64)
    key = key[at]
    starts = np.searchsorted(key >> U(32), np.arange(len(context) + 1, dtype=U))
    return context, starts, (key & LOW).astype(np.uint32), counts


def packed(context: np.ndarray, starts: np.ndarray, third: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(shard, keys, counts) for each shard among the contexts."""
    order = np.argsort(shard, kind="stable")
    runs = np.diff(starts)
    cuts = firsts(shard[order])
    for a, z in zip(cuts, [*cuts[1:], len(order)]):
        own = order[a:z]
        n = runs[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        middle, left = (context[own] >> U(32)).astype(np.uint32), (context[own] & LOW).astype(np.uint32)
        head = np.array([len(own), len(at)], np.uint32).tobytes()
        step = np.diff(middle, prepend=np.uint32(0)).astype(np.uint32)
        keys = head + planes(step) + planes(left) + planes(n.astype(np.uint32)) + planes(third[at])
        yield int(shard[own[0]]), keys, planes(counts[at].astype(np.uint32))


def unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(middle, left, third, counts) of a record's triples."""
    contexts, triples = (int(x) for x in np.frombuffer(keys[:8], np.uint32))
    at = 8 + 4 * contexts * np.arange(4)
    step, left, n = (unplaned(keys[at[i]:at[i + 1]], np.uint32) for i in range(3))
    return np.repeat(np.cumsum(step, dtype=np.uint32), n), np.repeat(left, n), unplaned(keys[at[3]:], np.uint32), unplaned(counts, np.uint32)


def write_groups(folder: str, name: str, shard: int, major: np.ndarray, minor: np.ndarray) -> None:
    """Sorted (major, minor): each major once, and the minors of each."""
    at = firsts(major)
    write_file(f"{folder}/{name}-{shard}.major", major[at].astype(np.uint32).tobytes())
    write_file(f"{folder}/{name}-{shard}.at", np.append(at, len(major)).astype(np.uint32).tobytes())
    write_file(f"{folder}/{name}-{shard}.minor", minor.astype(np.uint32).tobytes())


def write_pairs(folder: str, name: str, shard: int, keys: np.ndarray, counts: np.ndarray) -> None:
    write_groups(folder, name, shard, (keys >> U(32)).astype(np.uint32), (keys & LOW).astype(np.uint32))
    write_file(f"{folder}/{name}-{shard}.counts", narrowest(counts))


def write_triples(folder: str, shard: int, context: np.ndarray, starts: np.ndarray, third: np.ndarray, counts: np.ndarray) -> None:
    write_groups(folder, "contexts", shard, (context >> U(32)).astype(np.uint32), (context & LOW).astype(np.uint32))
    write_file(f"{folder}/triples-{shard}.at", starts.astype(np.uint32).tobytes())
    write_file(f"{folder}/triples-{shard}.minor", third.tobytes())
    write_file(f"{folder}/triples-{shard}.counts", narrowest(counts))
    long = np.flatnonzero(np.diff(starts) > LONG)
    sums = sums_of(counts, starts[long], starts[long + 1])
    write_file(f"{folder}/triples-{shard}.long", np.column_stack([long, sums]).astype(np.int64).tobytes())


def sums_of(counts: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each range of ``counts``: their total, and how many are 1, 2, and more."""
    out = np.zeros((len(lo), 4), np.int64)
    n = hi - lo
    if not n.sum():
        return out
    ends = np.cumsum(n)
    c = counts[np.repeat(lo - (ends - n), n) + np.arange(ends[-1])].astype(np.int64)
    of = np.repeat(np.arange(len(lo)), n)
    for j, x in enumerate((c, c == 1, c == 2, c >= 3)):
        run = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        out[:, j] = run[ends] - run[ends - n]
    return out


def search_within(array: np.ndarray, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each x in its sorted range of ``array``, -1 if it isn't there."""
    lo, end, at = lo.astype(np.int64), hi.astype(np.int64), np.arange(len(x))
    hi = end.copy()
    at = at[lo < hi]
    while len(at):
        middle = (lo[at] + hi[at]) >> 1
        less = array[middle] < x[at]
        lo[at[less]] = middle[less] + 1
        hi[at[~less]] = middle[~less]
        at = at[lo[at] < hi[at]]
    inside = np.flatnonzero(lo < end)
    found = np.full(len(x), -1, np.int64)
    hit = inside[array[lo[inside]] == x[inside]]
    found[hit] = lo[hit]
    return found


def _array(folder: str, name: str, dtype) -> np.ndarray:
    return shared_arrays.get(f"{folder}/{name}", dtype)


def _narrow(folder: str, name: str, n: int) -> np.ndarray:
    counts = _array(folder, name, np.uint8)  # of the narrowest type that holds the shard's largest
    return counts.view(f"u{len(counts) // n}")


def find_groups(folder: str, name: str, shard: int, major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """The place of each (major, minor) among the minors, -1 if it isn't there."""
    majors = _array(folder, f"{name}-{shard}.major", np.uint32)
    if not len(majors):
        return np.full(len(major), -1, np.int64)
    at = _array(folder, f"{name}-{shard}.at", np.uint32)
    i = np.minimum(np.searchsorted(majors, major.astype(np.uint32)), len(majors) - 1)
    there = majors[i] == major
    return search_within(_array(folder, f"{name}-{shard}.minor", np.uint32), at[i], np.where(there, at[i + 1], at[i]), minor)


def pair_counts(folder: str, name: str, shard: int, major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    place = find_groups(folder, name, shard, major, minor)
    out, found = np.zeros(len(place), np.int64), place >= 0
    if found.any():
        out[found] = _narrow(folder, f"{name}-{shard}.counts", len(_array(folder, f"{name}-{shard}.minor", np.uint32)))[place[found]]
    return out


def triple_counts(folder: str, shard: int, middle: np.ndarray, left: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums of the contexts as in ``sums_of``) of triples; third words under 0 are unknown."""
    counts, sums = np.zeros(len(middle), np.int64), np.zeros((len(middle), 4), np.int64)
    place = find_groups(folder, "contexts", shard, middle, left)
    known = np.flatnonzero(place >= 0)
    if not len(known):
        return counts, sums
    at = _array(folder, f"triples-{shard}.at", np.uint32)
    minors = _array(folder, f"triples-{shard}.minor", np.uint32)
    stored = _narrow(folder, f"triples-{shard}.counts", len(minors))
    context, back = np.unique(place[known], return_inverse=True)
    lo, hi = at[context].astype(np.int64), at[context + 1].astype(np.int64)
    long = hi - lo > LONG
    of = np.zeros((len(context), 4), np.int64)
    of[~long] = sums_of(stored, lo[~long], hi[~long])
    if long.any():
        table = _array(folder, f"triples-{shard}.long", np.int64).reshape(-1, 5)
        of[long] = table[np.searchsorted(table[:, 0], context[long]), 1:]
    sums[known] = of[back]
    found = search_within(minors, lo[back], hi[back], third[known])
    counts[known[found >= 0]] = stored[found[found >= 0]]
    return counts, sums
