"""Words of whole texts as 64-bit hashes, for whole Arrow batches at once.

Words are `[^\\x20\\x09-\\x0D]+`, lower-cased in A-Z. Texts go through numpy in slices
of about a quarter of a megabyte (a longer text is a slice of its own): a word array is eight times as large, and several live at once
in each of an executor's workers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"): ord("Z") + 1] += 32
_VALUE = mix(_FOLD.astype(_U) + _U(0x1234567))
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, _U(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """Words of some texts: hash, first byte and byte after the last, counted within its
    text; words of text i are first[i] .. first[i + 1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes."""
    _, offsets = buffers(texts)
    at, n = 0, len(texts)
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


LETTERS_ONLY = np.ones(256, bool)
LETTERS_ONLY[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def words(texts: pa.Array, separator: np.ndarray = _SEPARATOR) -> Words:
    """All words of the given texts (a slice; see `slices`), parted at the `separator` bytes."""
    raw, offsets = buffers(texts)
    base = offsets[0]
    data = raw[base: offsets[-1]]
    bounds = offsets - base
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, _U), none, none, np.zeros(len(bounds), np.int64))
    inside = ~separator[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    begins[edges] |= inside[edges]
    stops[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    power, inverse = _power_tables(n)
    total = np.zeros(n + 1, _U)
    np.cumsum(_VALUE[data] * power, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(_U))
    first = np.searchsorted(starts, bounds)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Words(hashes, starts - bounds[owner], ends - bounds[owner], first)


_SHIFTS = [_U(pow(_BASE, 2 * i + 3, 1 << 64)) for i in range(64)]


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words, in order; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for i in range(size):
        total += hashes[i: i + n] * _U(pow(_BASE, 2 * i + 3, 1 << 64))
    return mix(total)


def shingle_sets(found: Words, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle as a whole."""
    grams = gram_hashes(found.hashes, size)
    sets = []
    for a, z in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if z - a >= size:
            sets.append(np.unique(grams[a: z - size + 1]))
        elif z > a:
            whole = gram_hashes(found.hashes[a:z], z - a) ^ _U(z - a)
            sets.append(mix(whole))
        else:
            sets.append(np.zeros(0, _U))
    return sets


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
