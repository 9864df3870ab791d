"""Fill-in-the-middle transformation by displacement scatter.

Lines are the units: two of a text's line ends, taken from the hash of the seed and the id, cut
it into prefix, middle and suffix, which the output holds in another order behind markers.

A batch is one stretch of bytes. Scanning it for line breaks gives every cut; the segments'
displacements go into a difference array at their first bytes, whose cumulative sum is the
shift of every byte, and one scatter writes all texts of the batch, markers at their own places.
Going back, the markers are found in the output, the same difference array is built from them,
and one gather through it brings every byte home (``restored`` needs output and form only).

Rows: a null text is empty; an empty text, one that holds a marker, and one that the rate leaves
out are plain, their output is the text. A null id hashes as the seed and ':' alone. Repeated
rows come out as often as they came; a clashing column of the input is ignored (only ``doc_id``
and ``text`` are read); an empty table gives an empty result. A long text is a step of its own,
its shifts are built in windows of WINDOW bytes, so a task holds its bytes in and out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.llm.common import steps, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3                                             # bytes of a marker
FORMS = ("plain", "psm", "spm")
#: Bytes whose shifts are held at once.
WINDOW = 1 << 20


def draws(seed: int, doc_id: str = "doc_id") -> list[Column]:
    """Four unsigned 32-bit numbers from sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _markers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all markers in the bytes of a batch, and their letters."""
    at = np.flatnonzero(data[:-2] == PREFIX[0]) if len(data) > 2 else np.zeros(0, np.int64)
    letter = data[at + 1] if len(at) else np.zeros(0, np.uint8)
    good = (np.isin(letter, [PREFIX[1], SUFFIX[1], MIDDLE[1]]) & (data[at + 2] == PREFIX[2])) if len(at) else np.zeros(0, bool)
    return at[good], letter[good]


def _inside(at: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Row of each marker position, -1 where it reaches beyond its row's end."""
    row = np.searchsorted(offs, at, "right") - 1
    return np.where(at + MARK <= offs[row + 1], row, -1)


def _displaced(starts: np.ndarray, shifts: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """``position + shift`` of the bytes lo..hi, where segment i begins at starts[i] (rising, the
    last of equal starts counts): differences at the starts, then their cumulative sum."""
    first, last = np.searchsorted(starts, [lo, hi], "left")
    before = shifts[first - 1] if first else 0
    diff = np.zeros(hi - lo, np.int64)
    np.add.at(diff, starts[first:last] - lo, np.diff(shifts[first:last], prepend=before))
    return np.cumsum(diff) + before + np.arange(lo, hi)


def _segments(lo: np.ndarray, a: np.ndarray, b: np.ndarray, hi: np.ndarray, form: np.ndarray, out: np.ndarray):
    """Where the three segments of every row begin in the text, and how far each is displaced to
    its place in the output (row begins at ``out`` there)."""
    head, mid, tail = a - lo, b - a, hi - b
    moved = form > 0
    spm = form == 2
    prefix_at = out + np.where(spm, 2 * MARK + tail, np.where(moved, MARK, 0))
    suffix_at = out + np.where(spm, MARK, np.where(moved, 2 * MARK + head, head + mid))
    middle_at = out + np.where(moved, 3 * MARK + head + tail, head)
    starts = np.stack([lo, a, b], 1).ravel()
    shifts = np.stack([prefix_at - lo, middle_at - a, suffix_at - b], 1).ravel()
    return starts, shifts, prefix_at, suffix_at, middle_at


def _transform(rate: int, spm_share: int):
    def run(batches):
        for batch in steps(batches, "text"):
            data, offs = utf8(batch.column("text"))
            lo, hi = offs[:-1] - offs[0], offs[1:] - offs[0]
            data = data[offs[0]:offs[-1]]
            offs = offs - offs[0]
            h = [batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4)]
            breaks = np.flatnonzero(data == 10)
            first = np.searchsorted(breaks, lo)                       # the first line break of each row
            n_breaks = np.searchsorted(breaks, hi) - first
            open_end = (hi > lo) & (data[np.maximum(hi - 1, 0)] != 10) if len(data) else np.zeros(len(lo), bool)
            n = n_breaks + open_end
            at, _ = _markers(data)
            held = np.zeros(len(lo), bool)
            rows = _inside(at, offs)
            held[rows[rows >= 0]] = True
            form = np.where((hi == lo) | held | (h[2] % 100 >= rate), 0, np.where(h[3] % 100 < spm_share, 2, 1))

            def end_of(unit):                                         # bytes up to the end of this many units
                inner = breaks[np.minimum(first + unit - 1, len(breaks) - 1)] + 1 if len(breaks) else lo
                return np.where(unit == 0, lo, np.where(unit > n_breaks, hi, inner))

            one, two = h[0] % (n + 1), h[1] % (n + 1)
            moved = form > 0
            a = np.where(moved, end_of(np.minimum(one, two)), lo)
            b = np.where(moved, end_of(np.maximum(one, two)), lo)
            sizes = hi - lo + np.where(moved, 3 * MARK, 0)
            ends = np.cumsum(sizes)
            starts, shifts, p, s, m = _segments(lo, a, b, hi, form, ends - sizes)
            out = np.empty(int(ends[-1]), np.uint8)
            chars = np.zeros(len(data) + 1, np.int32)                 # characters before each byte
            np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
            for w in range(0, len(data), WINDOW):
                z = min(w + WINDOW, len(data))
                out[_displaced(starts, shifts, w, z)] = data[w:z]
            for mark, places in ((PREFIX, p), (SUFFIX, s), (MIDDLE, m)):
                for j in range(MARK):
                    out[places[moved] - MARK + j] = mark[j]
            texts = pa.LargeStringArray.from_buffers(len(lo), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out))
            plain = pa.array(~moved)
            counts = [pc.if_else(plain, pa.scalar(None, pa.int64()), pa.array((chars[y] - chars[x]).astype(np.int64))) for x, y in ((lo, a), (a, b))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(np.array(FORMS, object)[form], pa.string()), *counts, texts.cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transformed(docs: DataFrame, seed: int, rate: int = 100, spm_share: int = 50) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n, form, prefix_chars, middle_chars, output``. ``rate`` percent of
    the texts are cut, ``spm_share`` percent of those have the suffix first."""
    rows = docs.select("doc_id", "text", *(h.alias(f"h{i + 1}") for i, h in enumerate(draws(seed))))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_transform(rate, spm_share),
                           f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def _restore(batches):
    for batch in steps(batches, "output"):
        data, offs = utf8(batch.column("output"))
        data, offs = data[offs[0]:offs[-1]], offs - offs[0]
        lo, hi = offs[:-1], offs[1:]
        form = np.array([FORMS.index(f) for f in batch.column("form").to_pylist()], np.int64)
        at, letter = _markers(data)
        rows = _inside(at, offs)
        where = {}
        for mark in (PREFIX, SUFFIX, MIDDLE):                         # a row that is not plain holds each marker once
            place = lo.copy()
            mine = (letter == mark[1]) & (rows >= 0)
            mine[mine] = form[rows[mine]] > 0
            place[rows[mine]] = at[mine]
            where[mark] = place
        p, s, m = where[PREFIX], where[SUFFIX], where[MIDDLE]
        moved, spm = form > 0, form == 2
        head = np.where(spm, m, s) - p - MARK
        tail = np.where(spm, p, m) - s - MARK
        sizes = np.where(moved, hi - lo - 3 * MARK, hi - lo)
        ends = np.cumsum(sizes)
        text_lo = ends - sizes
        a = np.where(moved, text_lo + head, text_lo)
        b = np.where(moved, ends - tail, text_lo)
        starts, shifts, *_ = _segments(text_lo, a, b, ends, form, lo)
        out = np.empty(int(ends[-1]), np.uint8)
        for w in range(0, len(out), WINDOW):
            z = min(w + WINDOW, len(out))
            out[w:z] = data[_displaced(starts, shifts, w, z)]
        texts = pa.LargeStringArray.from_buffers(len(lo), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out))
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.string())], [*names, "restored"])


def restored(made: DataFrame) -> DataFrame:
    """Adds ``restored``: the text that ``output`` was made of, from ``output`` and ``form`` alone."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
    return made.mapInArrow(_restore, f"{kept}, restored string")


def digest(docs: DataFrame, seed: int, rate: int = 100, spm_share: int = 50) -> DataFrame:
    """Transformation and restoration of every text, with digests of both."""
    return restored(transformed(docs, seed, rate, spm_share)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
