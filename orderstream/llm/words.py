"""Words of whole record batches as 64-bit hashes, in numpy.

A text's bytes are looked up in a table that gives each byte of a word a random
64-bit number (A-Z those of a-z) and each separator 0. A word's hash is the
polynomial of its numbers modulo 2^64, taken for all words at once from one
running sum, and then mixed. Long batches go piece by piece, cut between words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 1 << 20
_P = 0xD6E8FEB86659FD93 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            p = np.full(n, U(base), U)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U)
    return _powers[0], _powers[1]


def byte_table(is_word) -> np.ndarray:
    """The numbers of the bytes for which ``is_word`` holds."""
    with np.errstate(over="ignore"):
        numbers = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    table = np.array([numbers[b] if is_word(b) else 0 for b in range(256)], U)
    for b in range(65, 91):
        if is_word(b):
            table[b] = table[b + 32]
    return table


#: ASCII letters and digits and all characters beyond ASCII.
ALNUM = byte_table(lambda b: chr(b).isascii() and chr(b).isalnum() or b >= 128)
#: Everything but white space: blank, \t, \n, \v, \f, \r.
UNBLANK = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each row begins (and the last ends)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, at, data = column.buffers()
    starts = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[starts[0]:starts[-1]], starts - starts[0]


def _piece(data: np.ndarray, breaks: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word; ``breaks``: bytes where a text begins."""
    v = table[data]
    m = v != 0
    first = m.copy()
    first[1:] &= ~m[:-1]
    first[breaks] = m[breaks]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.empty(0, U), begin
    last = m.copy()
    last[:-1] &= ~m[1:]
    inner = breaks[breaks > 0]
    last[inner - 1] = m[inner - 1]
    end = np.flatnonzero(last) + 1
    power, inverse = _powers_to(len(data) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(data) + 1, U)
        np.cumsum(v * power[:len(data)], dtype=U, out=run[1:])
        h = (run[end] - run[begin]) * inverse[begin]
        return mix(h + (end - begin).astype(U) * U(0x9E3779B97F4A7C15)), begin


def hash_words(data: np.ndarray, starts: np.ndarray, table: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, index of each text's first word with the total at the end)."""
    hashes, places, at, n = [], [], 0, len(data)
    while at < n:
        stop = min(n, at + piece)
        while stop < n:  # forward to a separator or a text's beginning
            ahead = data[stop:stop + 4096]
            gap = np.flatnonzero(table[ahead] == 0)
            k = np.searchsorted(starts, stop)
            nearest = min(gap[0] + stop if len(gap) else n, starts[k] if k < len(starts) else n)
            if nearest <= stop + len(ahead):
                stop = int(nearest)
                break
            stop += len(ahead)
        lo, hi = np.searchsorted(starts, at), np.searchsorted(starts, stop)
        h, begin = _piece(data[at:stop], (starts[lo:hi] - at), table)
        hashes.append(h)
        places.append(begin + at)
        at = stop
    if not hashes:
        return np.empty(0, U), np.zeros(len(starts), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), starts).astype(np.int64)


def hash_batch(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data, starts = buffers(column)
    return hash_words(data, starts, table)
