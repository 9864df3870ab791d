"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts makes each document's set of distinct 5-word shingles (64-bit
   hashes), a 128-bit digest of the set, K minima, of which the low b bits are kept and
   packed into a signature, and one key for each band of R of the first BANDS * R minima.
2. Equal sets fold into one class (map-side combined, so thousands of copies are one row).
3. Band keys that several classes share give candidates: each class with the smallest
   class of its band. The signature estimates similarity by counting equal lanes with bit
   counts, corrected for chance collisions; of the candidates that could be similar the
   best is confirmed on full sets, and confirmed links are joined to components. This goes
   over a few bands first and then, for what is still apart, over all.
4. Then every pair that shares a band key and still lies in different components is
   estimated inside the join, at the first key that the two share, and those that could be
   similar are confirmed on full sets. Classes under a crowded key (more than CROWDED classes)
   first get FINE further minima, and their pairs are estimated by these too inside the join.
   So a large group of near copies never becomes all its pairs, and no link between
   components is lost.

With R = 4 and 32 bands a pair at the threshold 0.75 misses all bands with a chance of
5e-6. The estimate goes out at 4.2 standard errors below the threshold: 0.58 from the first
COARSE minima (steps 3 and 4), 0.69 from all K (step 4), 0.72 from FINE (crowded keys).

Rows: a null or empty text has an empty set, links with nothing and is its own
component; repeated rows (and repeated ids) are allowed, they share what their texts
share; a null id never becomes a component's name unless all its ids are null. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.llm.common import free, mix, odd_numbers, steps, stored, tidy, utf8
from calforge.llm.components import components, relabel
from calforge.llm.words import shingle_sets

K, COARSE, R, BANDS, B_BITS, WORDS = 1024, 128, 4, 32, 4, 5
FIRST_BANDS = 4
#: Minima of the second signature, and the classes of a band key above which its classes get one.
FINE, CROWDED = 4096, 32
SIMILAR = (75, 100)
LANES = 64 // B_BITS
CHANCE = 2.0 ** -B_BITS
_MINIMA = odd_numbers(K, 11)
_BAND = odd_numbers(R + 1, 13)
_FINE = odd_numbers(FINE, 17)
SIGNATURES = "doc_id bigint, h bigint, n_shingles bigint, d1 bigint, d2 bigint, sig array<bigint>, bands array<bigint>"


def _rows_of(values: np.ndarray) -> pa.Array:
    """A 2-D uint64 array as an Arrow list column of bigint."""
    n, m = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * m + 1, m, dtype=np.int32)),
                                    pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64)))


def _packed(x: np.ndarray, start: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The low b bits of the minimum under each multiplier, packed, for every (non-empty) set in ``x``."""
    sig = np.zeros((len(start), len(multipliers) // LANES), np.uint64)
    with np.errstate(over="ignore"):
        for k, m in enumerate(multipliers):
            low = np.minimum.reduceat(x * m, start) >> np.uint64(32)
            sig[:, k // LANES] |= (low & np.uint64((1 << B_BITS) - 1)) << np.uint64(k % LANES * B_BITS)
    return sig


def _sign(x: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Digests, packed signature and band keys of the (non-empty) sets in ``x``."""
    with np.errstate(over="ignore"):
        start = offs[:-1]
        d1 = np.add.reduceat(mix(x + np.uint64(1)), start)
        d2 = np.add.reduceat(mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)), start)
        sig = np.zeros((len(start), K // LANES), np.uint64)
        bands = np.zeros((len(start), BANDS), np.uint64)
        for k in range(K):
            low = np.minimum.reduceat(x * _MINIMA[k], start) >> np.uint64(32)
            sig[:, k // LANES] |= (low & np.uint64((1 << B_BITS) - 1)) << np.uint64(k % LANES * B_BITS)
            if k < BANDS * R:
                bands[:, k // R] += low * _BAND[k % R]
        for t in range(BANDS):
            bands[:, t] = mix(bands[:, t] + np.uint64(t) * _BAND[R])
    return d1.view(np.int64), d2.view(np.int64), sig, bands


def _signatures(batches):
    for batch in steps(batches, "text"):
        sets, offs = shingle_sets(*utf8(batch.column("text")), WORDS)
        n = np.diff(offs)
        full = np.flatnonzero(n)
        d1 = np.zeros(len(n), np.int64)
        d2 = np.zeros(len(n), np.int64)
        sig = np.zeros((len(n), K // LANES), np.uint64)
        bands = np.zeros((len(n), BANDS), np.uint64)
        if len(full):
            d1[full], d2[full], sig[full], bands[full] = _sign(sets, np.append(offs[full], offs[-1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("h"), pa.array(n), pa.array(d1), pa.array(d2), _rows_of(sig),
             _rows_of(bands)], ["doc_id", "h", "n_shingles", "d1", "d2", "sig", "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> set size, set digest, packed b-bit signature, band keys."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"), "text") \
        .mapInArrow(tidy(_signatures), SIGNATURES)


def _finer(batches):
    for batch in steps(batches, "text"):
        sets, offs = shingle_sets(*utf8(batch.column("text")), WORDS)
        fine = _packed(sets, offs[:-1], _FINE)
        yield pa.RecordBatch.from_arrays([batch.column("v"), _rows_of(fine)], ["v", "fine"])


def at_least(k: int) -> float:
    """The least estimate from ``k`` minima of a pair that could be similar."""
    similar = SIMILAR[0] / SIMILAR[1]
    equal = similar * (1 - CHANCE) + CHANCE
    return similar - 4.2 * (equal * (1 - equal) / k) ** 0.5 / (1 - CHANCE)


def estimate(a: Column, b: Column, k: int = K) -> Column:
    """Similarity estimated from the first ``k`` lanes (at most COARSE, or all) of two packed signatures: the share of
    equal b-bit lanes, less what chance makes equal. A lane differs if any bit of the xor is
    set there."""
    ones = sum(1 << (B_BITS * i) for i in range(LANES))
    mask = ones if ones < 1 << 63 else ones - (1 << 64)

    def unequal(one: Column, two: Column) -> Column:
        x = one.bitwiseXOR(two)
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseAND(F.lit(mask)))

    if k <= COARSE:
        n = reduce(add, [unequal(a[i], b[i]) for i in range(k // LANES)])
    else:                  # as one expression this would be too long a method for the JIT compiler
        n = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), add)
    return (1.0 - n / F.lit(float(k)) - CHANCE) / (1.0 - CHANCE)


#: Shingles of the sets that a confirming task keeps for later pairs (8 bytes each).
HELD_SHINGLES = 1 << 20


def _confirm(batches):
    sets: dict[int, np.ndarray] = {}
    for batch in batches:
        cols = [batch.column(c) for c in ("a", "b", "text_a", "text_b")]
        good = []
        for a, b, ta, tb in zip(*(c.to_pylist() if i < 2 else c for i, c in enumerate(cols)), strict=True):
            both = []
            for v, t in ((a, ta), (b, tb)):
                if v not in sets:
                    if sum(map(len, sets.values())) > HELD_SHINGLES:
                        sets.clear()
                    sets[v] = shingle_sets(*utf8(pa.array([t.as_py()], pa.string())), WORDS)[0]
                both.append(sets[v])
            common = len(np.intersect1d(*both, assume_unique=True))
            good.append(SIMILAR[1] * common >= SIMILAR[0] * (len(both[0]) + len(both[1]) - common))
        yield pa.RecordBatch.from_arrays(cols[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))


def _texts(rows: DataFrame, column: str, name: str, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the text of the class in ``column``. Texts come from a shuffle of the documents by their key."""
    key = classes.select(F.col("v").alias(column), F.col("doc_id").alias("_id"), F.col("h").alias("_h"))
    found = docs.select(F.col("doc_id").cast("bigint").alias("_d"), F.xxhash64("text").alias("_k"), F.col("text").alias(name))
    return rows.join(key, column).join(found, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_k"))) \
        .drop("_id", "_h", "_d", "_k")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose full shingle sets are similar."""
    for side in ("b", "a"):
        pairs = _texts(pairs, side, f"text_{side}", classes, docs)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidy(_confirm), "a bigint, b bigint").distinct()


def finer(mixed: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``v, fine``: the second signature of every class that has a crowded key in ``mixed``."""
    crowded = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED)
    held = mixed.join(crowded, "key", "left_semi").select("v").distinct()
    return _texts(held, "v", "text", classes, docs).dropDuplicates(["v"]).select("v", "text") \
        .mapInArrow(tidy(_finer), "v bigint, fine array<bigint>")


def _stars(classes: DataFrame, joined: DataFrame, bands: int) -> DataFrame:
    """Candidates ``(a, b)``: classes with the first class of a band key, where the two lie in
    different components and could be similar; the best for each pair of components."""
    of = classes.join(joined, "v")
    rows = of.select("v", "c", F.explode(F.slice("bands", 1, bands)).alias("key"))
    lead = rows.groupBy("key").agg(F.min("v").alias("a"), F.min_by("c", "v").alias("ac"), F.min("c").alias("x"), F.max("c").alias("y")) \
        .where("x < y").select("key", "a", "ac")
    near = rows.join(lead, (rows["key"] == lead["key"]) & (rows["c"] != lead["ac"])).select("a", "ac", F.col("v").alias("b"), "c").distinct()
    sig = classes.select("v", F.slice("sig", 1, COARSE // LANES).alias("sig"))
    rated = (near.join(sig.withColumnsRenamed({"v": "a", "sig": "sa"}), "a")
             .join(sig.withColumnsRenamed({"v": "b", "sig": "sb"}), "b")
             .withColumn("like", estimate(F.col("sa"), F.col("sb"), COARSE)).where(F.col("like") >= at_least(COARSE)))
    best = F.max(F.struct("like", (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))).alias("m")
    return rated.groupBy("c", "ac").agg(best).select((-F.col("m.a")).alias("a"), (-F.col("m.b")).alias("b"))


def _likeliest(pairs: DataFrame) -> DataFrame:
    """The pair ``(a, b)`` with the highest estimate of every component, of ``a, b``, their components ``x, y`` and ``like``."""
    ends = pairs.select(F.explode(F.array("x", "y")).alias("end"), F.struct("like", "a", "b").alias("p"))
    return ends.groupBy("end").agg(F.max("p").alias("p")).select("p.a", "p.b").distinct()


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose classes still lie in different components."""
    c = joined.select("v", F.col("c").alias("root"))
    both = relabel(relabel(pairs.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y")), c, "x"), c, "y")
    return both.where("x <> y").select("a", "b")


def _merged(joined: DataFrame, pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``joined`` (``v, c``) after the links among ``pairs``."""
    found, c = confirmed(pairs, classes, docs), joined.select("v", F.col("c").alias("root"))
    roots = components(relabel(relabel(found, c, "a"), c, "b"))
    return stored(relabel(joined, roots, "c").select("v", "c"), "joined")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, h, n_shingles, component_id, kept`` for every row; ``h``
    is the hash of its text."""
    signed = stored(signatures(docs), "signed")
    classes = stored(signed.where("n_shingles > 0").groupBy("d1", "d2")
                     .agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h")).alias("first"),
                          F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands"))
                     .select(F.monotonically_increasing_id().alias("v"), "d1", "d2", "first.doc_id", "first.h",
                             "sig", "bands"), "classes")
    joined = classes.select("v", F.col("v").alias("c"))
    # first a few bands, whose stars join most of each group; then the stars of all bands, between what is still apart
    for bands in (FIRST_BANDS, BANDS):
        joined = _merged(joined, stored(_stars(classes, joined, bands), "stars"), classes, docs)
    rows = classes.join(joined, "v").select("v", "c", F.explode("bands").alias("key"))
    apart = rows.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("key")
    mixed = stored(rows.join(apart, "key", "left_semi"), "mixed")
    mixed = mixed.join(classes.select("v", "sig", "bands"), "v").join(stored(finer(mixed, classes, docs), "finer"), "v", "left")
    one, two = mixed.alias("one"), mixed.alias("two")
    pairs = one.join(two, (F.col("one.key") == F.col("two.key")) & (F.col("one.c") < F.col("two.c"))
                     & (estimate(F.col("one.sig"), F.col("two.sig"), COARSE) >= at_least(COARSE))
                     & (F.get(F.array_intersect("one.bands", "two.bands"), F.lit(0)) == F.col("one.key"))
                     & (estimate(F.col("one.sig"), F.col("two.sig")) >= at_least(K))
                     & F.coalesce(estimate(F.col("one.fine"), F.col("two.fine"), FINE) >= at_least(FINE), F.lit(True))) \
        .select(F.col("one.v").alias("a"), F.col("two.v").alias("b"), F.col("one.c").alias("x"), F.col("two.c").alias("y"),
                F.coalesce(estimate(F.col("one.fine"), F.col("two.fine"), FINE),
                           estimate(F.col("one.sig"), F.col("two.sig"))).alias("like"))
    pairs = stored(pairs, "pairs")
    # first the likeliest pair of every component; then all pairs between what is still apart
    joined = _merged(joined, stored(_likeliest(pairs), "likeliest"), classes, docs)
    joined = _merged(joined, stored(_apart(pairs, joined), "apart"), classes, docs)
    member = classes.select("v", "d1", "d2").join(joined, "v").select("d1", "d2", "c")
    placed = signed.select("doc_id", "h", "n_shingles", "d1", "d2").join(stored(member, "member"), ["d1", "d2"], "left")
    named = placed.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("name"))
    out = placed.join(named, "c", "left").withColumn(
        "component_id", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("name")))
    return out.select("doc_id", "h", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that lead their component: one document of each group stays, once."""
    lead = stored(near_duplicates(docs).where("kept").groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")), "lead")
    d, h = free(docs, "_d", "_h")
    key = lead.select(F.col("doc_id").alias(d), F.col("h").alias(h))
    kept = docs.join(key, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(h)), "left_semi")
    return kept if lead.where("n > 1").isEmpty() else kept.dropDuplicates(["doc_id", "text"])
