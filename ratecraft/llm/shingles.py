"""Hashed word shingles of texts, computed on whole Arrow batches with numpy.

A word is a run of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Hashes have 64
bits; a pair of texts of 1000 shingles each confuses two of them with a
probability of about 1e-13.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ratecraft.llm.arrow_text import ragged, utf8

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (two rounds of shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_known_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(is white space, code) of every byte."""
    if _known_tables:
        return _known_tables[0]
    byte = np.arange(256)
    space = (byte == 32) | ((byte >= 9) & (byte <= 13))
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    _known_tables.append((space, mixed((lower.astype(np.uint64) + np.uint64(1)) * _ODD)))
    return _known_tables[0]


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _known_powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 20), base)
        known[0] = 1
        _known_powers[int(base)] = known = np.cumprod(known)
    return known[:n]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, number of words of each text)."""
    data, ends = utf8(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    space, code = _tables()
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)          # a text starts or ends here
    edge[ends] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code[data] * _powers(_ODD, n))])
    own = (sums[stops] - sums[starts]) * _powers(_ODD_INVERSE, n)[starts]
    hashes = mixed(own + (stops - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, ends))


def shingle_sets(texts: pa.Array, size: int = 3) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle, none are none."""
    words, counts = word_hashes(texts)
    firsts = np.cumsum(counts) - counts
    full = np.maximum(counts - size + 1, 0)
    at = ragged(firsts, full)
    factors = np.cumprod(np.full(size, _ODD))
    total = np.full(len(at), np.uint64(size))
    for k in range(size):
        total += words[at + k] * factors[k]
    hashes = mixed(total)
    stops = np.cumsum(full)
    sets = []
    for i, (count, stop, n) in enumerate(zip(counts.tolist(), stops.tolist(), full.tolist(), strict=True)):
        if n:
            sets.append(np.unique(hashes[stop - n:stop]))
        elif count:
            own = (words[firsts[i]:firsts[i] + count] * factors[:count]).sum(keepdims=True)
            sets.append(mixed(own + np.full(1, count, np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
