"""Secret scans, in DataFrame functions only.

Base kinds (assign, access, hex) come from fixed patterns. The method adds kind
``random``: a token of an encoding alphabet that passes for random where ordinary text
would not. A battery looks at each candidate under the encoding inferred from its
characters:

* a token of letters of one case, or without a digit, is taken for a word, one of digits
  for a number;
* how ordinary it is: the corpus gives the kinds of characters (upper, lower, digit, sign)
  that follow each other in its long tokens, and the characters within a kind. The chance
  that such text makes a token is set against the chance that random characters make it.
  By Markov's inequality their ratio bounds how often ordinary tokens look this random, at
  any length. Changes of case and to digits count in it, and paths, names and numbers are
  ordinary by it. It is learned twice, the second time without what the first took for random;
* chi-squared for uniform use of the alphabet, runs above and below its middle, and serial
  correlation of neighbours, each against what random characters give. A token that fails
  one of them is not random.

The chances go through false-discovery control (Benjamini and Hochberg) over all
candidates of the corpus, in classes of encoding and length, since short tokens have far
less to go by and are far more. The control needs only counts by class and rounded
chance, so it is a small table however large the corpus.

Rows: a null text is empty; repeated rows come out as often as they came in; a null id is
an id; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calforge.llm.common import free, let, stored
from calforge.llm.spans import find_spans

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
#: Encoding by pattern, with its alphabet in the order of its values; the first that fits holds.
_DIGITS, _UP, _LOW = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (("digits", r"^[0-9]+$", _DIGITS), ("hex", r"^[0-9a-f]+$", _DIGITS + "abcdef"), ("HEX", r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
             ("lower", r"^[a-z]+$", _LOW), ("upper", r"^[A-Z]+$", _UP), ("base32", r"^[A-Z2-7]+$", _UP + "234567"),
             ("upper36", r"^[A-Z0-9]+$", _DIGITS + _UP), ("lower36", r"^[a-z0-9]+$", _DIGITS + _LOW),
             ("base64url", r"^[A-Za-z0-9_-]+$", _UP + _LOW + _DIGITS + "-_"), ("base64", "", _UP + _LOW + _DIGITS + "+/_-"))
CHARS = ENCODINGS[-1][2]
FALSE_DISCOVERIES = 0.001
RANDOM_ENOUGH = 3.0          # deviations that runs and serial correlation may be off
LEAST_LENGTH = 20
WORD_LENGTH = 64             # longer tokens say nothing of how ordinary words use letters
DOUBTFUL = 10.0              # bits by which a token must look random to be no example of an ordinary one
PRIOR, STAY = 100.0, 0.9     # what is known of ordinary tokens beforehand: their neighbours are of one kind
SPAN = "array<struct<kind:string,s:int,e:int>>"


def _kind(kind: str, spans: Column, keep=None) -> Column:
    spans = F.filter(spans, keep) if keep else spans
    return F.transform(spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, k, base, candidates``: one pass over the texts."""
    t = F.coalesce("text", F.lit(""))
    base = F.concat(_kind("assign", find_spans(t, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 6),
                    _kind("access", find_spans(t, ACCESS)), _kind("hex", find_spans(t, HEX)))
    return docs.select("doc_id", F.xxhash64("text").alias("k"), base.cast(SPAN).alias("base"),
                       find_spans(t, CANDIDATE).alias("candidates"))


def _steps(m: Column) -> Column:
    """For each character: the kind of the one before (4 at the start) and its place in CHARS, as one number."""
    def kind(x):
        return F.when(x < 26, 0).when(x < 52, 1).when(x < 62, 2).otherwise(3)
    places = F.transform(F.split(m, ""), lambda c: F.instr(F.lit(CHARS), c) - 1)
    return let(places, lambda v: F.zip_with(
        F.concat(F.array(F.lit(4)), F.transform(F.slice(v, F.lit(1), F.size(v) - 1), kind)), v, lambda p, x: p * len(CHARS) + x))


def _ordinary(tokens: DataFrame) -> list[float]:
    """``steps`` -> the bits of each step in ordinary tokens, by counts and PRIOR."""
    size = len(CHARS)
    n = [0.0] * (5 * size)
    for r in tokens.select(F.explode("steps").alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")).collect():   # at most 330 rows
        n[r["x"]] = float(r["n"])
    ends = (0, 26, 52, 62, size)
    kinds = [range(a, z) for a, z in zip(ends[:-1], ends[1:], strict=True)]
    bits = [0.0] * len(n)
    for k, places in enumerate(kinds):
        used = {x: 1 + sum(n[p * size + x] for p in range(5)) for x in places}
        total = sum(used.values())
        for p in range(5):
            expected = PRIOR * (0.25 if p == 4 else STAY if p == k else (1 - STAY) / 3)
            follows = (expected + sum(n[p * size + x] for x in places)) / (PRIOR + sum(n[p * size:(p + 1) * size]))
            for x in places:
                bits[p * size + x] = -math.log2(follows * used[x] / total)
    return bits


def _battery(tokens: DataFrame) -> DataFrame:
    """``m`` -> ``m, enc, n, size, steps, chi2_z, runs_z, serial_z``: the tests of each distinct token."""
    enc, alphabet = F.lit("base64"), F.lit(ENCODINGS[-1][2])
    for name, pattern, chars in reversed(ENCODINGS[:-1]):
        fits = F.col("m").rlike(pattern)
        enc, alphabet = F.when(fits, name).otherwise(enc), F.when(fits, chars).otherwise(alphabet)
    t = tokens.select("m", F.length("m").alias("n"), enc.alias("enc"), alphabet.alias("alphabet"))
    t = t.withColumn("v", F.transform(F.split("m", ""), lambda c: F.instr(F.col("alphabet"), c) - 1))
    t = t.withColumn("size", F.length("alphabet")).withColumn("mean", F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / F.col("n"))
    counts = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.size(F.filter("v", lambda x: x == i)).cast("double"))
    t = t.withColumn("squares", F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x))
    t = t.withColumn("high", F.size(F.filter("v", lambda x: x >= F.col("size") / 2)))
    nxt = F.slice("v", F.lit(2), F.col("n") - 1)
    pairs = F.zip_with(F.slice("v", F.lit(1), F.col("n") - 1), nxt, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    half = F.col("size") / 2
    t = t.withColumn("runs", 1 + F.size(F.filter(pairs, lambda p: (p["a"] >= half) != (p["b"] >= half))))
    cov = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - F.col("mean")) * (p["b"] - F.col("mean")))
    var = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean")))
    n, hi = F.col("n").cast("double"), F.col("high").cast("double")
    lo = n - hi
    mu = 2 * hi * lo / n + 1
    sd = F.sqrt(F.greatest((mu - 1) * (mu - 2) / (n - 1), F.lit(1e-9)))
    free = F.col("size") - 1
    return t.select("m", "enc", "n", "size", _steps(F.col("m")).alias("steps"),
                    ((F.col("size") * F.col("squares") / n - n - free) / F.sqrt(2 * free * (n - 1) / n)).alias("chi2_z"),
                    F.when((hi == 0) | (lo == 0), F.lit(99.0)).otherwise((F.col("runs") - mu) / sd).alias("runs_z"),
                    F.when(var <= 0, F.lit(99.0)).otherwise(cov / var * F.sqrt(n)).alias("serial_z"))


def random_tokens(tokens: DataFrame) -> DataFrame:
    """``m`` (distinct tokens) -> the tokens ``m`` that the battery and the
    false-discovery control call random."""
    tested = stored(_battery(tokens), "battery")

    def gain(bits):
        """Bits by which random characters make the token more likely than ordinary text does."""
        cost = F.lit(bits)
        return F.aggregate("steps", F.lit(0.0), lambda a, x: a + F.get(cost, x)) - F.col("n") * F.log2("size")
    words = tested.where(F.col("n") <= WORD_LENGTH)
    ordinary = _ordinary(words.where(gain(_ordinary(words)) < DOUBTFUL))
    rare = F.least(F.greatest(gain(ordinary), F.lit(0.0)) * math.log10(2), F.lit(30.0))
    rated = tested.where(F.col("n") >= LEAST_LENGTH).where("enc not in ('digits', 'lower', 'upper')").where(F.col("m").rlike("[0-9]")).select(
        "m", "enc", F.floor(F.log2("n") * 2).alias("len"), "chi2_z", "runs_z", "serial_z", F.round(rare, 2).alias("rare"))
    counts = rated.groupBy("enc", "len", "rare").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("enc", "len")
    ranked = counts.withColumn("rank", F.sum("n").over(by.orderBy(F.desc("rare")))).withColumn("all", F.sum("n").over(by))
    limit = ranked.where(F.pow(F.lit(10.0), -F.col("rare")) * F.col("all") <= FALSE_DISCOVERIES * F.col("rank")) \
        .groupBy("enc", "len").agg(F.min("rare").alias("limit"))
    return rated.join(limit, ["enc", "len"]).where("rare >= limit") \
        .where((F.col("chi2_z") <= RANDOM_ENOUGH) & (F.abs("runs_z") <= RANDOM_ENOUGH) & (F.abs("serial_z") <= RANDOM_ENOUGH)).select("m")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then by the order of KINDS."""
    rank = F.array(*(F.lit(k) for k in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.array_position(rank, x["kind"]).alias("r"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, k, base, spans``: spans are ``array<struct<kind, s, e>>``;
    ``spans`` holds the base ones and the random tokens that overlap none of them."""
    seen = stored(scanned(docs), "scanned")
    each = seen.where(F.size("candidates") > 0).select("doc_id", "k", "base", F.explode("candidates").alias("c")) \
        .select("doc_id", "k", "base", "c.s", "c.e", "c.m")
    found = random_tokens(each.select("m").distinct())
    more = each.where(~F.exists("base", lambda b: (b["s"] < F.col("e")) & (F.col("s") < b["e"]))).join(found, "m") \
        .groupBy("doc_id", "k").agg(F.collect_set(F.struct(F.lit("random").alias("kind"), "s", "e")).alias("more"))
    got = more.withColumnsRenamed({"doc_id": "_d", "k": "_k"})
    return seen.join(got, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k")), "left").select(
        "doc_id", "k", "base", F.concat("base", F.coalesce("more", F.array().cast(SPAN))).cast(SPAN).alias("spans"))


def secret_report(docs: DataFrame) -> DataFrame:
    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return find_secrets(docs).select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                                     joined(F.col("spans")).alias("spans"))


def masked(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span in ``text`` (merged where they overlap) replaced by ``mask``."""
    d, k, spans = free(docs, "_d", "_k", "_spans")
    hits = find_secrets(docs).where(F.size("spans") > 0).select(F.col("doc_id").alias(d), F.col("k").alias(k), F.col("spans").alias(spans)).distinct()
    hit = docs.join(hits, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(k)), "left")
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    piece = F.aggregate(ordered, start, lambda acc, x: F.struct(
        F.greatest(acc["at"], x["e"]).alias("at"),
        F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, x["s"] - acc["at"]), F.lit(mask)))
         .otherwise(acc["out"]).alias("out")))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(
        let(piece, lambda p: F.concat(p["out"], F.col("text").substr(p["at"] + 1, F.length("text")))))
    out = hit.withColumn("text", text).drop(d, k, spans)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out
