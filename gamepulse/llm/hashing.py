"""Word hashes of whole Arrow text columns in numpy, without a Python loop over words.

Texts are taken as UTF-8 bytes. The separators are the ASCII bytes 0x20 and 0x09-0x0D, so
splitting bytes equals splitting code points. A word's 64-bit hash is a polynomial over
randomised byte values, read from running sums; equal words have equal hashes everywhere.
The only tables kept in a process are two of STRETCH powers, 2 MB in all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_GOLD = 0x9E3779B97F4A7C15
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
STRETCH = 1 << 17  # bytes hashed at a time; the tables of powers have this length, whatever the texts


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(base: int) -> np.ndarray:
    """base**0 … base**(STRETCH-1) modulo 2^64."""
    steps = np.full(STRETCH, base, U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(_GOLD))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, null as empty, and its n+1 offsets from 0."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of every text (n+1 values).

    `gaps` says for every byte value whether it lies between words.
    """
    inside = ~gaps[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of disjoint byte spans of data, in order.

    One running sum per stretch of STRETCH bytes: a span inside it is a difference of two sums, one that
    goes on adds up its parts, moved on by the power of the distance from its start. So memory is bounded
    for any length of data or span.
    """
    out = np.zeros(len(starts), U64)
    sums = np.zeros(STRETCH + 1, U64)
    for low in range(int(starts[0]) if len(starts) else 0, len(data), STRETCH):
        high = min(low + STRETCH, len(data))
        a, b = np.searchsorted(starts, (low, high))
        begun = a and ends[a - 1] > low  # a span that began in an earlier stretch
        if a == b and not begun:
            continue
        np.cumsum(BYTE_VALUES[data[low:high]] * _POWERS[:high - low], out=sums[1:high - low + 1])
        own, stop = starts[a:b] - low, np.minimum(ends[a:b], high) - low
        out[a:b] = (sums[stop] - sums[own]) * _INVERSES[own]
        if begun:
            with np.errstate(over="ignore"):
                out[a - 1] += sums[min(int(ends[a - 1]), high) - low] * U64(pow(_BASE, low - int(starts[a - 1]), 1 << 64))
    return mix(out)


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column in order, and the first word of every text (n+1 values)."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(data, starts, ends), first


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words; the caller leaves out runs that cross texts."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(words) - n + 1, U64)
    for k in range(n):
        out = mix(out * U64(_GOLD) + words[k:k + len(out)])
    return out


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its n-word shingles; a shorter text is one shingle."""
    words, first = word_hashes(column)
    runs = ngram_hashes(words, n)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        elif b > a:
            out.append(ngram_hashes(words[a:b], int(b - a)) ^ U64(b - a))
        else:
            out.append(np.zeros(0, U64))
    return out
