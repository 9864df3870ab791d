"""Language-model scores by prediction by partial matching.

A byte-context trie with escape estimation and symbol exclusion (``ppm``) codes whole
texts, either with statistics pretrained on a corpus (``pretrained``) or adaptively, from
the text's own past alone (``adaptive``). Counts go over all training texts: each task
counts grams of ORDER + 1 bytes, and Spark adds them up; the trie is whole at every size.

No task holds the trie. The probability of a byte depends on its gram alone, so every
distinct gram of the texts to score is rated once: grams that agree in their last two context
bytes go to one task, which so holds all contexts of two bytes and more of these grams;
the shorter ones (at most 65,792 counts) are sent to all. A text's score is the sum over
its grams. The ratings of about TOP_GRAMS grams that occur most often are sent to every
executor; what a text holds beside these goes through a join with all ratings. The bound
changes how a rating travels, never the score.

Beside it stands the word base: counts of all words of all training texts. A vocabulary
has no bound, so only the counts of about TOP_WORDS most frequent words go to every executor;
what a text holds beside these goes through the same join.

Rows: a null text is empty (one token, the end); repeated rows come out as often as they
came in, and train as often; null ids are scored and train; extra columns are ignored; an
empty table gives an empty result; without training texts every byte costs 8 bits. Words
are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.llm import ppm
from calforge.llm.common import steps, stored, utf8
from calforge.llm.words import word_hashes

ORDER, TOP_GRAMS, TOP_WORDS = 4, 600_000, 400_000
ADAPTIVE_ORDER = 3
END_OF_TEXT = np.uint64(0xE0D)          # the token that ends a text, beside the hashes of words
COUNTS = "kind tinyint, item bigint, n bigint, used bigint"
GRAM, WORD = 0, 1
#: Grams that a task rates at once; one group holds at most 2^24 (two more context bytes and the byte itself).
RATED_AT_ONCE = 1 << 18


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offs = utf8(batch.column("text"))
    words, row = word_hashes(data, offs)
    rows = len(offs) - 1
    return np.concatenate([words, np.full(rows, END_OF_TEXT)]), np.concatenate([row, np.arange(rows)])


def _count(batches):
    """By task: of the grams and of the words, how often training texts hold them (``n``) and
    how often texts hold them at all (``used``)."""
    held = {GRAM: [], WORD: []}

    def added(parts):
        keys, n, used = (np.concatenate(x) for x in zip(*parts, strict=True))
        names, sums = ppm._grouped(keys, n)
        return names, sums, ppm._grouped(keys, used)[1]

    def out(kind, *columns):
        for a in range(0, len(columns[0]), 1 << 16):
            k, n, used = (c[a:a + (1 << 16)] for c in columns)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int8)), pa.array(k.view(np.int64)), pa.array(n), pa.array(used)],
                                             ["kind", "item", "n", "used"])

    def counted(keys, learn):
        names, place = np.unique(keys, return_inverse=True)
        return names, np.bincount(place[learn], minlength=len(names)), np.bincount(place, minlength=len(names))

    for batch in steps(batches, "text"):
        learn = ~np.array(batch.column("held_out").to_pylist(), bool)
        for key, row in ppm.grams(*utf8(batch.column("text")), ORDER):
            held[GRAM].append(counted(key, learn[row]))
        token, row = _tokens(batch)
        held[WORD].append(counted(token, learn[row]))
        for kind, parts in held.items():
            if sum(len(p[0]) for p in parts) > 3_000_000:
                held[kind] = [added(parts)]
                if len(held[kind][0][0]) > 1_500_000:
                    yield from out(kind, *held[kind].pop())
    for kind, parts in held.items():
        if parts:
            yield from out(kind, *added(parts))


def _most_used(items: DataFrame, most: int, value: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """``item, <value>`` of the items used most, sorted: as many classes of use (eighths of a
    doubling) as fit ``most`` items whole."""
    rank = F.floor(F.log2("used") * 8)
    least, held = 0, 0
    for r in items.groupBy(rank.alias("r")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("r")).collect():    # at most 512 classes
        held += r["c"]
        if held > most:
            least = r["r"] + 1
            break
    kept = items.where(rank >= least).select("item", value).toPandas()
    item = kept["item"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(item)
    return item[order], kept[value].to_numpy(kind)[order]


def _rated(grams: DataFrame) -> DataFrame:
    """``item, n, used`` -> ``item, used, x``: the log10 probability of each gram's last byte
    under the statistics of all grams."""
    low = [(n, grams.where("n > 0").groupBy(F.col("item").bitwiseAND((1 << 8 * n) - 1).alias("item")).agg(F.sum("n").alias("n")).toPandas())
           for n in (1, 2)]                                      # at most 256 and 65,536 rows
    sent = grams.sparkSession.sparkContext.broadcast({n: (t["item"].to_numpy(np.uint64), t["n"].to_numpy(np.int64)) for n, t in low})

    def rate(batches):
        held: list[np.ndarray] = []                              # rows of item, n, used; the last group may go on

        def rated(part):
            item, n, used = part
            gram = item.view(np.uint64)
            known = n > 0
            model = ppm.Model(gram[known], n[known], ORDER, low=sent.value)
            return pa.RecordBatch.from_arrays([pa.array(item), pa.array(used), pa.array(model.bits(gram) * math.log10(2))], ["item", "used", "x"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(c).to_numpy() for c in ("item", "n", "used")]))
            if sum(h.shape[1] for h in held) < RATED_AT_ONCE:
                continue
            part = np.concatenate(held, 1)
            group = part[0] >> 8 & 0xFFFF
            whole = int(np.argmax(group == group[-1]))           # groups lie together: all before the last are whole
            if whole:
                yield rated(part[:, :whole])
            held = [part[:, whole:]]
        if held:
            yield rated(np.concatenate(held, 1))

    group = F.shiftright("item", 8).bitwiseAND(0xFFFF)
    return grams.select("item", "n", "used", group.alias("g")).repartition("g").sortWithinPartitions("g").select("item", "n", "used") \
        .mapInArrow(rate, "item bigint, used bigint, x double")


def _split(items: np.ndarray, rows: np.ndarray, top: tuple[np.ndarray, np.ndarray]):
    """Which ``items`` are among the top ones, their values, and of the others ``(row, item, times)``."""
    names, value = top
    at = np.minimum(np.searchsorted(names, items), max(0, len(names) - 1))
    here = names[at] == items if len(names) else np.zeros(len(items), bool)
    left = np.flatnonzero(~here)
    left = left[np.lexsort((items[left], rows[left]))]
    item, row = items[left], rows[left]
    new = np.ones(len(left), bool)
    new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return here, value[at[here]], row[first], item[first], np.diff(np.append(first, len(left)))


def pretrained(docs: DataFrame, held_out: Column) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` for every row, with word and byte statistics of the rows not held out."""
    context = docs.sparkSession.sparkContext
    texts = docs.select("doc_id", "text", held_out.alias("held_out"))
    totals = stored(texts.select("text", "held_out").mapInArrow(_count, COUNTS)
                    .groupBy("kind", "item").agg(F.sum("n").alias("n"), F.sum("used").alias("used")), "totals")
    words = totals.where(F.col("kind") == WORD).where("n > 0")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    values = stored(_rated(totals.where(F.col("kind") == GRAM).select("item", "n", "used")).withColumn("kind", F.lit(GRAM))
                    .unionByName(words.select("item", "used", F.log10(F.col("n") + 1.0).alias("x"), F.lit(WORD).alias("kind"))), "values")
    top = context.broadcast([_most_used(values.where(F.col("kind") == kind), most, "x", float)          # bounded by their parameters
                             for kind, most in ((GRAM, TOP_GRAMS), (WORD, TOP_WORDS))])

    def rate(batches):
        for batch in steps(batches, "text"):
            rows = batch.num_rows
            token, row = _tokens(batch)
            here, x, *rest = _split(token, row, top.value[WORD])
            left = [(WORD, *rest)]
            part, score = np.bincount(row[here], x, rows).astype(float), np.zeros(rows)      # (bincount of nothing gives integers)
            for key, at in ppm.grams(*utf8(batch.column("text")), ORDER):
                got, y, *rest = _split(key, at, top.value[GRAM])
                score += np.bincount(at[got], y, rows)
                left.append((GRAM, *rest))
            kinds = np.concatenate([np.full(len(r), k) for k, r, _, _ in left])
            owner, item, times = (np.concatenate([one[i] for one in left]) for i in (1, 2, 3))
            order = np.argsort(owner, kind="stable")
            ends = pa.array(np.searchsorted(owner[order], np.arange(rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(np.bincount(row, minlength=rows)),
                pa.array(np.bincount(row[here], minlength=rows)), pa.array(part), pa.array(score),
                *(pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in (kinds.astype(np.int32), item.view(np.int64), times))],
                ["doc_id", "held_out", "n_tokens", "known", "part", "score", "kinds", "items", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rated = stored(texts.mapInArrow(rate, f"doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, part double, score double, kinds array<int>, "
                                    "items array<bigint>, times array<bigint>").withColumn("r", F.monotonically_increasing_id()), "rated")

    def of(which, column):
        return F.sum(F.when(F.col("kind") == which, column))

    rest = rated.select("r", F.explode(F.arrays_zip("kinds", "items", "times")).alias("e")) \
        .select("r", F.col("e.kinds").alias("kind"), F.col("e.items").alias("item"), "e.times") \
        .join(values.select("kind", "item", "x"), ["kind", "item"]) \
        .groupBy("r").agg(of(WORD, F.col("times")).alias("more"), of(WORD, F.col("times") * F.col("x")).alias("add"),
                          of(GRAM, F.col("times") * F.col("x")).alias("add_score"))
    return rated.join(rest, "r", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("part") + F.coalesce("add", F.lit(0.0)) - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("score") + F.coalesce("add_score", F.lit(0.0))).alias("score"))


def _adaptive(batches):
    for batch in steps(batches, "text", 1):
        data, offs = utf8(batch.column("text"))
        bits = [adaptive_bits(data[a:z].tobytes()) for a, z in zip(offs[:-1], offs[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits, pa.float64())], ["doc_id", "bits"])


def adaptive_bits(text: bytes, order: int = ADAPTIVE_ORDER) -> float:
    """Code length of one text whose statistics are its own past: method C with symbol
    exclusion, counts updated in every context after each byte."""
    trie: dict[bytes, dict[int, int]] = {}
    past, bits = b"", 0.0
    for symbol in [*text, ppm.END]:
        out: set[int] = set()
        for n in range(len(past), -2, -1):
            if n < 0:
                bits += math.log2(max(1, ppm.SYMBOLS - len(out)))
                break
            seen = {s: c for s, c in trie.get(past[len(past) - n:], {}).items() if s not in out}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if symbol in seen:
                bits -= math.log2(seen[symbol] / total)
                break
            bits -= math.log2(len(seen) / total)
            out |= seen.keys()
        for n in range(len(past) + 1):
            node = trie.setdefault(past[len(past) - n:], {})
            node[symbol] = node.get(symbol, 0) + 1
        past = (past + bytes([symbol]))[-order:]
    return bits


def adaptive(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, bits``: the adaptive code length of each text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_adaptive, f"doc_id {kind}, bits double")
