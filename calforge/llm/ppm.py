"""Prediction by partial matching over bytes with frozen statistics, in numpy.

A text is its UTF-8 bytes and one end symbol (0xFF, which UTF-8 never uses), read after
start symbols (0xFE). Statistics are counts of grams, that is, of a context of ORDER bytes
and the byte after it; shorter contexts are sums of these, so the trie of contexts is
whole. Escapes are estimated by method C: a context seen ``total`` times with ``distinct``
symbols gives a symbol count / (total + distinct) and an escape distinct / (total + distinct).
With symbol exclusion, what the longer context knows takes no part in the shorter one. As
every symbol of a context is one of its suffix too, the excluded set belongs to the pair
of the two, and all denominators can be worked out beforehand: a text is scored by looking
up its grams, longest first, in a hash table, for all its positions at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

START, END, SYMBOLS = 0xFE, 0xFF, 256
#: Bytes of text whose grams are held at once, with some ten numbers for each.
STRETCH = 1 << 19
#: Bytes of the table in which a scorer keeps what its models say.
KNOWN_BYTES = 32 << 20
_HASH = np.uint64(0x9E3779B97F4A7C15)


def _tag(length: int) -> np.uint64:
    return np.uint64(length << 56)


def _mask(length: int) -> np.uint64:
    return np.uint64((1 << (8 * length)) - 1)


def grams(data: np.ndarray, offs: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For stretches of the rows: the gram that ends at each position (last byte lowest)
    and the row of each. A long text is cut; its parts take the bytes before them along."""
    parts, size = [], 0
    for row in range(len(offs) - 1):
        lo, hi = int(offs[row]), int(offs[row + 1])
        for a in range(lo, max(hi, lo + 1), STRETCH):
            z = min(hi, a + STRETCH)
            parts.append((row, lo, a, z, z == hi))
            size += z - a
            if size >= STRETCH:
                yield _stretch(data, parts, order)
                parts, size = [], 0
    if parts:
        yield _stretch(data, parts, order)


def _stretch(data, parts, order):
    lens = np.array([z - a + last for _, _, a, z, last in parts])
    buf = np.full(int(lens.sum()) + order * len(parts), START, np.uint8)
    keep = np.ones(len(buf), bool)
    at = 0
    for (_, lo, a, z, last), n in zip(parts, lens, strict=True):
        back = min(order, a - lo)
        buf[at + order - back:at + order] = data[a - back:a]
        buf[at + order:at + order + z - a] = data[a:z]
        if last:
            buf[at + order + n - 1] = END
        keep[at:at + order] = False
        at += order + int(n)
    key = np.zeros(len(buf), np.uint64)
    for j in range(order + 1):
        key[j:] |= buf[:len(buf) - j].astype(np.uint64) << np.uint64(8 * j)
    return key[keep], np.repeat(np.array([p[0] for p in parts]), lens)


def _grouped(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


class _Table:
    """Open addressing: 64-bit keys (never 0) to rows of float32."""

    def __init__(self, size: int, width: int):
        """Room for ``size`` keys; at most half of the slots get used."""
        bits = max(4, int(2 * size).bit_length())
        self.shift, self.last = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.zeros((1 << bits, width), np.float32)
        self.used, self.room = 0, size

    def add(self, keys: np.ndarray, rows: np.ndarray) -> _Table:
        """Put distinct new keys in."""
        left = np.arange(len(keys))
        slot = (keys * _HASH) >> self.shift
        while len(left):
            free = self.keys[slot[left]] == 0
            _, one = np.unique(slot[left[free]], return_index=True)
            put = left[free][one]
            self.keys[slot[put]] = keys[put]
            self.rows[slot[put]] = rows[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + np.uint64(1)) & self.last
        self.used += len(keys)
        return self

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots, or -1."""
        slot = (keys * _HASH) >> self.shift
        there = self.keys[slot]
        out = np.where(there == keys, slot.view(np.int64), -1)
        left = np.flatnonzero((there != keys) & (there != 0))
        while len(left):
            slot[left] = (slot[left] + np.uint64(1)) & self.last
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = slot[left[hit]]
            left = left[~hit & (there != 0)]
        return out


class Model:
    """Frozen PPM statistics; sums of log2 probabilities come from :meth:`score`."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, exclusion: bool = True, at_least: int = 1,
                 low: dict[int, tuple[np.ndarray, np.ndarray]] | None = None):
        """``keys``/``counts``: grams of ``order + 1`` bytes. Grams of three bytes and more
        that were seen less than ``at_least`` times are left out; sums go over the rest, so
        the probabilities of each context still add up to one. ``low`` gives grams and counts of
        the lowest lengths where ``keys`` are only those of some of their contexts."""
        self.order, self.exclusion = order, exclusion
        with np.errstate(over="ignore", divide="ignore"):
            level = {}
            keys, counts = _grouped(keys, counts.astype(np.int64))
            for n in range(order + 1, 0, -1):
                keys, counts = _grouped(*low[n]) if low and n in low else _grouped(keys & _mask(n), counts)
                kept = counts >= at_least if n > 2 else counts > 0
                level[n] = keys[kept], counts[kept].astype(np.float64)
            gram_keys, gram_rows, ctx_keys, ctx_rows = [], [], [], []
            before = None
            for n in range(1, order + 2):
                g, c = level[n]
                ctx, place = np.unique(g >> np.uint64(8), return_inverse=True)
                total, distinct = np.bincount(place, c, len(ctx)), np.bincount(place, minlength=len(ctx)).astype(np.float64)
                full = np.log2(total + distinct)
                rows = np.zeros((len(ctx), 3))
                rows[:, 0] = np.log2(distinct) - full
                if n > 1:
                    shorter, up_total, up_distinct = before
                    up = np.searchsorted(shorter, ctx & _mask(n - 2))
                    if exclusion:
                        own = level[n - 1][1][np.searchsorted(level[n - 1][0], g & _mask(n - 1))]
                        rest = np.maximum(up_total[up] - np.bincount(place, own, len(ctx)), 0)
                        more = np.maximum(up_distinct[up] - distinct, 0)
                    else:
                        rest, more = up_total[up], up_distinct[up]
                    known = more > 0
                    rows[known, 1] = np.log2(rest[known] + more[known])
                    rows[known, 2] = np.log2(more[known]) - rows[known, 1]
                gram_keys.append(g | _tag(n))
                gram_rows.append(np.stack([np.log2(c), np.log2(c) - full[place]], 1))
                ctx_keys.append(ctx | _tag(n))
                ctx_rows.append(rows)
                before = ctx, total, distinct
            self.last = -np.log2(max(1, SYMBOLS - len(level[1][0])) if exclusion else SYMBOLS)
            self.empty = not len(level[1][0])
            self.grams = _Table(sum(map(len, gram_keys)), 2).add(np.concatenate(gram_keys), np.concatenate(gram_rows))
            self.contexts = _Table(sum(map(len, ctx_keys)), 3).add(np.concatenate(ctx_keys), np.concatenate(ctx_rows))

    def bits(self, key: np.ndarray) -> np.ndarray:
        """log2 probability at each position from its gram of ``order + 1`` bytes."""
        out = np.zeros(len(key))
        if self.empty:
            return out - 8.0
        left, prev = np.arange(len(key)), np.full(len(key), -1)
        with np.errstate(over="ignore"):
            for n in range(self.order + 1, 0, -1):
                k = key[left] & _mask(n)
                slot = self.grams.find(k | _tag(n))
                hit = slot >= 0
                got, fresh = self.grams.rows[slot[hit]], prev[hit] < 0
                out[left[hit]] += np.where(fresh, got[:, 1], got[:, 0] - self.contexts.rows[prev[hit], 1])
                left, prev, k = left[~hit], prev[~hit], k[~hit]
                if not len(left):
                    return out
                here = self.contexts.find((k >> np.uint64(8)) | _tag(n))
                cost = np.where(prev >= 0, self.contexts.rows[prev, 2], np.where(here >= 0, self.contexts.rows[here, 0], 0.0))
                out[left] += cost
                prev = here
            out[left] += self.last
        return out

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log2 probability of each row's whole text and its end."""
        total = np.zeros(len(offs) - 1)
        for key, row in grams(data, offs, self.order):
            total += np.bincount(row, self.bits(key), len(total))
        return total


class Scorer:
    """Scores texts under several models of one order. Grams come back all the time, so what
    the models say of a gram is kept in one table of about KNOWN_BYTES, however many models
    there are, which starts anew when it is full."""

    def __init__(self, models: Sequence[Model], room: int | None = None):
        slots = max(17, (KNOWN_BYTES // (8 + 4 * len(models))).bit_length() - 1)
        self.models, self.order, self.room = models, models[0].order, room or (1 << (slots - 1)) - 1
        self.known = _Table(self.room, len(models))

    def _rated(self, keys: np.ndarray) -> np.ndarray:
        return np.stack([m.bits(keys) for m in self.models], 1)

    def _look_up(self, key: np.ndarray) -> np.ndarray:
        tagged = key | _tag(self.order + 1)
        slot = self.known.find(tagged)
        miss = np.flatnonzero(slot < 0)
        if not len(miss):
            return self.known.rows[slot]
        new = np.unique(tagged[miss])
        if self.known.used + len(new) > self.room:
            new, place = np.unique(tagged, return_inverse=True)
            if len(new) > self.room:
                return self._rated(new & _mask(self.order + 1)).astype(np.float32)[place]
            self.known = _Table(self.room, len(self.models))
            miss = np.arange(len(key))
        self.known.add(new, self._rated(new & _mask(self.order + 1)))
        slot[miss] = self.known.find(tagged[miss])
        return self.known.rows[slot]

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log2 probability of each row's text under each model."""
        total = np.zeros((len(offs) - 1, len(self.models)))
        for key, row in grams(data, offs, self.order):
            with np.errstate(over="ignore"):
                rated = self._look_up(key)
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            total[row[first]] += np.add.reduceat(rated, first, axis=0, dtype=np.float64)
        return total
