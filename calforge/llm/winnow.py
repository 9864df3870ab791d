"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed; every K-word gram gets a hash; in every window of W grams the minimum
is kept, on both sides. A shared span of K + W - 1 = 10 words holds a whole window, whose
minimum is the same in a document and in the item: it is never missed. Kept grams of the
documents join those of the benchmark, and a hit is extended to both sides word by word
(over the hashes of the words). Each 10-word window has its own kept gram within it, so
the 5 words on either side of a gram are all that an extension needs, and they travel
with it: no text is read or shuffled again. An item of fewer than 10 words is one window;
for the few lengths there are, grams of just that length stand for themselves (a window
of one gram).

A document's row count travels along as a row of its own, so there is one scan, one join
and one grouping by document, on hits that are pre-aggregated where they arise.

Rows: a null text has no words; repeated rows of a document come out as often as they
came in; items that share an id count as one item; a null item id is no item (its
windows still hit); extra columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.llm.common import free, let

SPAN_WORDS, K = 10, 5
W = SPAN_WORDS - K + 1
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """A-Z lower-cased, then runs of digits, a-z and everything outside ASCII."""
    t = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.array_remove(F.split(low, NOT_WORD), "")


def _grams_of(h: Column, k: int) -> Column:
    """Hashes of all k-word grams from the hashes of the words."""
    def all_of(ws):
        whole = F.transform(ws, lambda x, i: F.xxhash64(F.lit(k), x, *(F.get(ws, i + j) for j in range(1, k))))
        return F.slice(whole, F.lit(1), F.greatest(F.size(ws) - (k - 1), F.lit(0)))
    return let(h, all_of)


def _seeds(rows: DataFrame, k: int, w: int, own: bool = False) -> DataFrame:
    """``..., h`` (hashes of words) -> ``..., at, gram, left, near``: the k-word grams that
    are the leftmost minimum of a window of ``w`` grams, each once, with the words around
    them. A window brings a new minimum if its last gram is below those before it, or if
    the gram that just left was the minimum. Runs as generated code over one array.
    With ``own`` each input row also gives a row at -1 that holds its number of words."""
    n = F.size("h") - (k + w - 1)
    rows = rows.withColumn("g", _grams_of(F.col("h"), k))
    if own:
        at = rows.withColumn("i", F.explode(F.sequence(F.lit(-1), F.greatest(n, F.lit(-1)))))
    else:
        at = rows.where(n >= 0).withColumn("i", F.explode(F.sequence(F.lit(0), n)))
    if w > 1:
        g = [F.get("g", F.col("i") + j) for j in range(-1, w)]
        inner = F.least(*g[1:w])
        at = at.where((F.col("i") <= 0) | (g[w] < F.least(g[0], inner)) | (g[0] <= inner))
    window = F.slice("g", F.greatest(F.col("i"), F.lit(0)) + 1, F.lit(w))
    at = at.withColumn("gram", F.when(F.col("i") < 0, F.xxhash64("k")).otherwise(F.array_min(window)) if own else F.array_min(window))
    at = at.withColumn("at", F.when(F.col("i") < 0, F.col("i"))
                       .otherwise(F.col("i") + F.array_position(window, F.col("gram")).cast("int") - 1))
    left = F.least("at", F.lit(SPAN_WORDS - k))
    return at.select(*(c for c in rows.columns if c not in "gh"), "at", "gram",
                     F.when(F.col("at") < 0, F.size("h")).otherwise(left).alias("left"),
                     F.when(F.col("at") >= 0, F.slice("h", F.col("at") - left + 1, left + SPAN_WORDS)).alias("near"))


def grams(rows: DataFrame, short: list[int]) -> DataFrame:
    """Kept grams for spans of 10 words, and for each shorter item length all grams of it."""
    out = _seeds(rows, K, W, own=True)
    for k in short:
        out = out.unionByName(_seeds(rows, k, 1))
    return out


def _hashed(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def _equal_run(a: Column, b: Column) -> Column:
    """How many values two arrays have in common from their start."""
    n = F.least(F.size(a), F.size(b))
    at = F.array_position(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x == y), False)
    return F.when(at == 0, n.cast("bigint")).otherwise(at - 1).cast("int")


def _after(near: Column, left: Column) -> Column:
    return F.slice(near, left + 1, F.greatest(F.size(near) - left, F.lit(0)))


def _before(near: Column, left: Column) -> Column:
    return F.reverse(F.slice(near, F.lit(1), left))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text`` x ``item_id, text`` -> ``doc_id, k, n_words, ranges, items`` per
    document (``k`` is the hash of its text): ranges of hit words ``[s, e)`` and the ids of the items that occur."""
    items = benchmark.select("item_id", _hashed(words(F.col("text"))).alias("h")).withColumn("n", F.size("h")).where("n > 0")
    short = sorted(r[0] for r in items.where(F.col("n") < SPAN_WORDS).select("n").distinct().collect())
    marks = _seeds(items.where(F.col("n") >= SPAN_WORDS), K, W)
    for k in short:
        marks = marks.unionByName(_seeds(items.where(F.col("n") == k), k, 1))
    marks = marks.select("item_id", "n", "gram", F.col("left").alias("b_left"), F.col("near").alias("b_near"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("k"), _hashed(words(F.col("text"))).alias("h"))
    found = grams(hashed, short)
    joined = found.join(marks, (found["gram"] == marks["gram"]) & (found["at"] >= 0), "left").where("at < 0 or n is not null")
    right = _equal_run(_after(F.col("near"), F.col("left")), _after(F.col("b_near"), F.col("b_left")))
    back = _equal_run(_before(F.col("near"), F.col("left")), _before(F.col("b_near"), F.col("b_left")))
    ran = joined.select("doc_id", "k", "at", "left", "item_id", "n", right.alias("right"), back.alias("back"))
    full = F.col("right") + F.col("back") >= F.least("n", F.lit(SPAN_WORDS))
    hit = (F.col("at") >= 0) & full
    return ran.groupBy("doc_id", "k").agg(
        F.max(F.when(F.col("at") < 0, F.col("left"))).alias("n_words"),
        F.count(F.when(F.col("at") < 0, 1)).alias("copies"),
        F.collect_set(F.when(hit, F.struct((F.col("at") - F.col("back")).alias("s"), (F.col("at") + F.col("right")).alias("e")))).alias("ranges"),
        F.collect_set(F.when(hit, F.col("item_id"))).alias("items"),
    ).select("doc_id", "k", F.col("n_words").cast("bigint").alias("n_words"), "ranges", "items",
             F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_")).drop("_")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of :func:`hits` that reports need, one row for each row of ``docs``."""
    covered = F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["s"], r["e"] - 1))))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return hits(docs, benchmark).select(
        "doc_id", "n_words", F.size(covered).cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("ranges") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark."""
    d, k = free(docs, "_d", "_k")
    bad = hits(docs, benchmark).where(F.size("ranges") > 0).select(F.col("doc_id").alias(d), F.col("k").alias(k)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(k)), "left_anti")
