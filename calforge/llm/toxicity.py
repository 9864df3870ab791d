"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text, one on ordinary windows and one
on what recurs in toxic texts and ordinary ones do not hold; a window is compressed with the
ordinary one alone and with both, and the bytes that the toxic one saves are its gain.
A text is scored from the gains of all its windows, calibrated on the labelled sample.

For zstandard to see short words, text is expanded first: each byte becomes a 2-byte code
of itself and the two bytes before it (A-Z lower-cased). Codes cannot be compressed but by
a match, so a word that the dictionary knows saves two bytes a letter. Beside the ordinary
dictionary stands filler as long as the toxic one, so that both searches have the same
sizes and differ in the toxic content alone.

Training takes a bounded sample: of each label at most about SAMPLE_DOCS documents of at
most SAMPLE_CHARS characters, chosen by a hash of their id. It is fitted on the driver,
and gives dictionaries of at most ORDINARY_BYTES + TOXIC_BYTES, and a few numbers.

Rows: a null text is empty; an empty text scores like one without gains; repeated rows
come out as often as they came in, and repeated labels train as often; null ids are
scored; null labels do not train; extra columns are ignored; without labels of both kinds
every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.llm.common import odd_numbers, steps, utf8
from calforge.llm.langid import share
from calforge.llm.words import LOWER

SAMPLE_DOCS, SAMPLE_CHARS = 2500, 16_000
ORDINARY_BYTES, TOXIC_BYTES = 24 << 10, 12 << 10
WINDOW, STRIDE, LEVEL = 256, 240, 12
RECURS = 0.003                # share of toxic texts in which a likeness must recur
RARE = 0.002                  # share of ordinary windows that the gain of a telling window exceeds


def expand(text: np.ndarray) -> np.ndarray:
    """A 16-bit code of each byte and the two before it."""
    low = LOWER[text].astype(np.uint32)
    code = low.copy()
    code[1:] |= low[:-1] << np.uint32(8)
    code[2:] |= low[:-2] << np.uint32(16)
    with np.errstate(over="ignore"):
        code *= np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA77)
    return (code >> np.uint32(16)).astype(np.uint16)


def _triples(code: np.ndarray) -> np.ndarray:
    """Three codes in a row, that is, five letters, as one number."""
    c = code.astype(np.uint64)
    return c[:-2] << np.uint64(32) | c[1:-1] << np.uint64(16) | c[2:]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    samples = [s for s in samples if len(s) >= 16]
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:       # too little to train on: the samples themselves
        return b"".join(samples)[-size:]


class Classifier:
    def __init__(self, texts: list[bytes], toxic: np.ndarray):
        codes = [expand(np.frombuffer(t, np.uint8)) for t in texts]
        plain = [c for c, t in zip(codes, toxic, strict=True) if not t]
        bad = [c for c, t in zip(codes, toxic, strict=True) if t]
        self.usable = bool(plain) and bool(bad)
        if not self.usable:
            return
        usual = np.unique(np.concatenate([_triples(c) for c in plain]))
        often, n = np.unique(np.concatenate([np.unique(_triples(c)) for c in bad]), return_counts=True)
        often = np.setdiff1d(often[n >= max(2, RECURS * len(bad))], usual, assume_unique=True)
        left = []
        for c in bad:
            new = np.flatnonzero(np.isin(_triples(c), often))
            for run in np.split(new, np.flatnonzero(np.diff(new) > 1) + 1):
                if len(run) >= 2:
                    left.append(c[run[0]:run[-1] + 3].tobytes())
        self.ordinary = _dictionary([c[i:i + WINDOW].tobytes() for c in plain for i in range(0, len(c), WINDOW)], ORDINARY_BYTES)
        self.toxic = _dictionary(left, TOXIC_BYTES)
        both = self.compressors()
        gains = [self.gains(c, *both) for c in codes]
        calm = np.concatenate([g for g, t in zip(gains, toxic, strict=True) if not t])
        self.limit = float(np.quantile(calm, 1 - RARE))
        x = np.stack([self.features(g) for g in gains])
        self.centre, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        self.weights = _logistic((x - self.centre) / self.scale, toxic.astype(float))

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        filler = odd_numbers(TOXIC_BYTES // 8 + 1, 5).tobytes()[:len(self.toxic)]
        for content in (self.ordinary + filler, self.ordinary + self.toxic):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out[0], out[1]

    def gains(self, code: np.ndarray, one: zstandard.ZstdCompressor, two: zstandard.ZstdCompressor) -> np.ndarray:
        """Bytes that the toxic dictionary saves, for each window."""
        raw = memoryview(code.tobytes())
        cuts = range(0, max(1, len(code) - (WINDOW - STRIDE)), STRIDE)
        return np.array([len(one.compress(w)) - len(two.compress(w)) for w in (raw[2 * i:2 * (i + WINDOW)] for i in cuts)], float)

    def features(self, gains: np.ndarray) -> np.ndarray:
        over = np.maximum(gains - self.limit, 0)
        return np.array([math.log1p(over.max()), math.log1p(over.sum()), math.log1p((over > 0).sum())])

    def score(self, text: np.ndarray, both) -> float:
        z = self.weights[0] + ((self.features(self.gains(expand(text), *both)) - self.centre) / self.scale) @ self.weights[1:]
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps of a logistic regression with an intercept and a ridge."""
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """``doc_id, text`` and ``doc_id, toxic`` -> a classifier fitted on a bounded sample."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = marked.where(share(F.col("_id")) < F.when(F.col("toxic") == 1, SAMPLE_DOCS / counts.get(1, 1)).otherwise(SAMPLE_DOCS / counts.get(0, 1)))
    short = docs.where(F.length("text") <= SAMPLE_CHARS)
    rows = short.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("_id", "text", "toxic").orderBy("_id").toPandas()
    return Classifier([t.encode() for t in rows["text"]], rows["toxic"].to_numpy(bool))


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``..., text`` -> the other columns and ``score`` (0 to 1), for every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)       # bounded by the sizes of the dictionaries

    def rate(batches):
        own = sent.value
        both = own.compressors() if own.usable else None
        for batch in steps(batches, "text"):
            data, offs = utf8(batch.column("text"))
            out = [own.score(data[a:z], both) if both else 0.0 for a, z in zip(offs[:-1], offs[1:], strict=True)]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.float64())], [*names, "score"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(rate, f"{kept}, score double")


def predicted(score: Column, at: float = 0.7) -> Column:
    return (score >= at).cast("int")
