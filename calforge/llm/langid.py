"""Language identification by prediction by partial matching.

For each language a variable-order byte context tree with escape probabilities is trained
once and frozen; a text is given to the language that codes it in the fewest bits.

Training takes documents with a language from a bounded sample, chosen by a hash of their
id: about SAMPLE_DOCS of each language, and of a text of more than SAMPLE_CHARS characters
a stretch of that many, its place chosen by a hash. Every language that has a text gets a
model, which this bounds. The models go to the executors BLOCK languages at a time; where
there are more, what was the best so far is written with the texts between two blocks.
All texts are scored whole.

Rows: a null text or one without a letter is ``und`` with score 0; repeated rows come out
as often as they came in; null ids are scored, and train like others; extra columns are
ignored; an empty table, or one without any language, gives ``und`` for what there is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.llm import ppm
from calforge.llm.common import free, steps, stored, tidy, utf8

ORDER = 3
SAMPLE_DOCS, SAMPLE_CHARS, BLOCK = 1200, 20_000, 64
GRAMS = "lang string, gram bigint, n bigint"


def with_language(docs: DataFrame, models: dict[str, ppm.Model]) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in some learned language."""
    pred, score = free(docs, "_lang_pred", "_score")
    return identify(docs, models, True, (pred, score)).where(F.col(pred) != "und").select(*(f"`{c}`" for c in docs.columns))


def share(key: Column) -> Column:
    """A number from 0 to 1 that depends on the key alone."""
    return F.xxhash64(key).bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))


def _count(batches):
    for batch in steps(batches, "text"):
        langs, code = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        found = [[] for _ in langs]
        for key, row in ppm.grams(*utf8(batch.column("text")), ORDER):
            for i in range(len(langs)):
                found[i].append(key[code[row] == i])
        for i, keys in enumerate(found):
            gram, n = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([str(langs[i])] * len(gram), pa.string()), pa.array(gram.view(np.int64)),
                                              pa.array(n)], ["lang", "gram", "n"])


def train(labelled: DataFrame) -> dict[str, ppm.Model]:
    """``doc_id, text, lang`` -> a frozen model for each language."""
    usable = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    key = F.coalesce("doc_id", F.xxhash64("text"))
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    part = F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(F.substring("text", start, F.lit(SAMPLE_CHARS)))
    models = {}
    for i in range(0, len(counts), BLOCK):
        some = counts[i:i + BLOCK]          # as an Arrow table, so that no other kind of Python worker starts for it
        rates = labelled.sparkSession.createDataFrame(pa.table({"lang": pa.array([r["lang"] for r in some], pa.string()),
                                                                "rate": pa.array([SAMPLE_DOCS / r["n"] for r in some], pa.float64())}))
        sample = usable.join(F.broadcast(rates), "lang").where(share(key) < F.col("rate"))
        table = sample.select("lang", part.alias("text")).mapInArrow(tidy(_count), GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
        models |= {str(lang): ppm.Model(part["gram"].to_numpy(np.int64).view(np.uint64), part["n"].to_numpy(np.int64), ORDER, exclusion=False)
                   for lang, part in table.groupby("lang", sort=True)}
    return models


def identify(docs: DataFrame, models: dict[str, ppm.Model], keep_text: bool = False,
             out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``text`` and any other columns -> the others (and the text, if asked) and ``out``:
    the language and its score. The score is
    the share of the best language if code lengths, divided by the root of the text's
    length, were log2 probabilities."""
    names = sorted(models)
    blocks = [names[i:i + BLOCK] for i in range(0, len(names), BLOCK)] or [[]]
    letter, *before = free(docs, "_letter", "_best", "_top", "_sum")
    drop = {letter} if keep_text else {letter, "text"}
    state = dict(zip(before, ("string", "double", "double"), strict=True))
    found = docs.withColumn(letter, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        sent = docs.sparkSession.sparkContext.broadcast([models[x] for x in block])   # bounded by the sample and BLOCK
        kept = [f for f in found.schema if f.name not in state and not (last and f.name in drop)]
        new = dict(zip(out, ("string", "double"), strict=True)) if last else state
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"`{k}` {v}" for k, v in new.items())])
        found = found.mapInArrow(tidy(_best(block, sent, i == 0, last, [f.name for f in kept], list(new), letter, before)), schema)
        if not last:
            found = stored(found, "languages")
    return found


def _best(names, sent, first, last, kept, new, letter, before):
    """The best of ``names`` and of what was best before, for each row of the batches."""
    def predict(batches):
        own = ppm.Scorer(sent.value) if names else None
        for batch in steps(batches, "text", ppm.STRETCH):
            data, offs = utf8(batch.column("text"))
            some = np.array(batch.column(letter).to_pylist(), bool)
            if own:
                bits = own.score(data, offs) / np.sqrt(np.diff(offs) + 1.0)[:, None]
                top = bits.max(1)
                best = np.array(names, object)[bits.argmax(1)]
                total = np.exp2(bits - top[:, None]).sum(1)
                if not first:
                    up_best, up, up_total = (np.array(batch.column(c).to_pylist(), kind) for c, kind in zip(before, (object, float, float), strict=True))
                    best = np.where(top > up, best, up_best)
                    high = np.maximum(top, up)
                    total = total * np.exp2(top - high) + up_total * np.exp2(up - high)
                    top = high
            else:
                best, top, total, some = np.array(["und"] * len(some), object), np.zeros(len(some)), np.ones(len(some)), np.zeros(len(some), bool)
            got = [pa.array(np.where(some, best, "und").tolist(), pa.string()), pa.array(np.where(some, 1.0 / total, 0.0))] if last else \
                [pa.array(best.tolist(), pa.string()), pa.array(top), pa.array(total)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *got], [*kept, *new])
    return predict
