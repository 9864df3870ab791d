"""Vectorised words of UTF-8 text: A-Z lower-cased, split at ``[\\x20\\x09-\\x0D]+``.

A word becomes a 64-bit hash: a polynomial in its bytes, taken from prefix sums over
the whole buffer, then finalised with the length. All work is on byte arrays, a
bounded stretch at a time, cut only between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from calforge.llm.common import mix, odd_numbers

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are hashed at once, with some four numbers for each.
STRETCH = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_SHINGLE = odd_numbers(64, 7)
_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            _tables[:] = [np.cumprod(np.full(size, pow(_BASE, e, 1 << 64), np.uint64)) for e in (1, -1)]
    return _tables


def _stretches(data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    while hi - lo > STRETCH:
        cut = lo + STRETCH
        while cut < hi:
            blank = SPACE[data[cut:min(cut + 65536, hi)]]
            k = int(blank.argmax())
            if blank[k]:
                cut += k
                break
            cut += len(blank)
        yield lo, cut
        lo = cut
    if hi > lo:
        yield lo, hi


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row number of every word, in order."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    with np.errstate(over="ignore"):
        for lo, hi in _stretches(data, int(offs[0]), int(offs[-1])):
            b = data[lo:hi]
            n = len(b)
            blank = SPACE[b]
            first = offs[np.searchsorted(offs, lo):np.searchsorted(offs, hi)] - lo
            before, after = np.ones(n, bool), np.ones(n, bool)
            before[1:] = blank[:-1]
            before[first] = True
            after[:-1] = blank[1:]
            after[first[first > 0] - 1] = True
            s, e = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after)
            up, down = _powers(n)
            v = LOWER[b].astype(np.uint64)
            v += np.uint64(1)
            v *= up[:n]
            c = np.cumsum(v)
            h = (c[e] - c[s] + v[s]) * down[s]
            h += (e - s + 1).astype(np.uint64) * _SHINGLE[60]
            hashes.append(mix(h))
            rows.append(np.searchsorted(offs, s + lo, "right") - 1)
    return np.concatenate(hashes), np.concatenate(rows)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of every row, and their offsets.
    A row of fewer words has its whole sequence as one; one without words has none."""
    w, row = word_hashes(data, offs)
    rows = len(offs) - 1
    ends = np.searchsorted(row, np.arange(rows + 1))
    with np.errstate(over="ignore"):
        n = max(0, len(w) - k + 1)
        sh = np.zeros(n, np.uint64)
        for j in range(k):
            sh += w[j:j + n] * _SHINGLE[j]
        mix(sh)
        out, sizes = [np.zeros(0, np.uint64)], np.zeros(rows + 1, np.int64)
        for r in range(rows):
            a, z = int(ends[r]), int(ends[r + 1])
            if z - a >= k:
                x = np.sort(sh[a:z - k + 1])
                x = x[np.concatenate(([True], x[1:] != x[:-1]))]
            elif z > a:
                x = mix((w[a:z] * _SHINGLE[:z - a]).sum(keepdims=True) + np.uint64(z - a) * _SHINGLE[61])
            else:
                continue
            out.append(x)
            sizes[r + 1] = len(x)
    return np.concatenate(out), np.cumsum(sizes)
