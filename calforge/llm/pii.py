"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base kinds (email, ip, card, phone) come from fixed patterns and are the seeds. An
instance is a token with digits or an at sign; a pattern is the pair of words that stand
before and after it, or one of the two alone (so the start and the end of a text do no
harm). Each of these is a pattern for tokens of any shape, and once more with the shape of
the token (runs of digits, runs of letters, signs): the former lets what is known of one
shape find identifiers of another one, the latter lets a shape be telling where its
context holds much else. Where most tokens of a corpus are known, words that stand beside
them by accident hold known ones for the greater part too; so a pattern of one word or of
any shape must hold a telling word, one with more distinct instances beside it than its
frequency in all texts lets expect. Patterns and instances form a two-sided graph with one edge for
each pair that occurs. Each round rates a pattern by the share of its distinct instances that
are known, held down by few of them, and an instance by the best pattern that holds it;
instances of patterns above CONFIDENT become known and rate patterns in the next round.
In the end unseen tokens of confident patterns come out as kind ``found``.

The graph lies in the shared folder and is rated with map-side combined aggregates, so a
pattern with a third of all instances is one row per task before the shuffle.

Rows: a null text is empty; repeated rows come out as often as they came in; a null id is
an id; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.llm.common import let, stored
from calforge.llm.spans import find_spans

KINDS = ("email", "ip", "card", "phone", "found")
# Linear forms of the base patterns: a match can only start where a run starts (or at the end of
# the match before), and repeated groups are possessive, as nothing that follows could use them.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![^\s,;()<>\[\]{}\x22'])[^\s,;()<>\[\]{}\x22']*[0-9@][^\s,;()<>\[\]{}\x22']*"
LEAST_DIGITS = 6
ROUNDS, CONFIDENT, LEAST_SEEDS, REACH = 3, 0.75, 4, 80
TELLING = 3.0                # deviations above what the frequency of a word lets expect
SPAN = "array<struct<kind:string,s:int,e:int>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """From the right, every second digit doubled and its digits summed."""
    def total(d):
        values = F.transform(F.reverse(F.split(d, "")), lambda c, i: let(
            c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda v: v - F.when(v > 9, 9).otherwise(0)))
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)
    return let(_digits(m), lambda d: F.length(d).between(16, 19) & (total(d) % 10 == 0))


def _shape(m: Column) -> Column:
    """Runs of digits as 9, runs of letters as a, the rest as it is."""
    return F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), r"[^\W\d_]+", "a")


def _patterns(before: Column, after: Column, shape: Column) -> Column:
    """The words on both sides, the one before, the one after: each for any shape and for this one."""
    none = F.lit("")
    sides = F.array_distinct(F.array(F.concat_ws("\t", before, after), F.concat_ws("\t", before, none), F.concat_ws("\t", none, after)))
    return F.flatten(F.transform(F.filter(sides, lambda x: x != "\t"), lambda x: F.array(
        F.concat_ws("\t", x, none), F.concat_ws("\t", x, shape))))


def _small(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (
        F.coalesce(F.substring(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))), 1, 4).cast("int"), F.lit(0)) <= 255))


def _kind(kind: str, spans: Column, keep=None) -> Column:
    spans = F.filter(spans, lambda x: keep(x["m"])) if keep else spans
    return F.transform(spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, k, base, tokens``: one pass over the texts. A token
    carries the words on either side; base matches are tokens too, as some hold spaces."""
    def found(t):
        base = F.concat(_kind("email", find_spans(t, EMAIL)), _kind("ip", find_spans(t, IP), _small), _kind("card", find_spans(t, CARD), _luhn),
                        _kind("phone", find_spans(t, PHONE), lambda m: F.length(_digits(m)).between(8, 15)))
        wide = F.filter(find_spans(t, TOKEN), lambda x: (F.length(_digits(x["m"])) >= LEAST_DIGITS) | F.contains(x["m"], F.lit("@")))
        whole = F.transform(base.cast(SPAN), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), t.substr(x["s"] + 1, x["e"] - x["s"]).alias("m")))
        near = F.transform(F.array_distinct(F.concat(wide, whole)), lambda x: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"),
            F.regexp_extract(t.substr(F.greatest(x["s"] - REACH, F.lit(0)) + 1, F.least(x["s"], F.lit(REACH))), r"(\S+)\s+\z", 1).alias("before"),
            F.regexp_extract(t.substr(x["e"] + 1, F.lit(REACH)), r"\A\S?\s+(\S+)", 1).alias("after")))
        return F.struct(base.cast(SPAN).alias("base"), near.alias("tokens"))
    # every kind holds a digit or an at sign: a text without either needs no further look
    some = F.when(F.col("text").rlike("[0-9@]"), F.col("text")).otherwise("")
    return docs.select("doc_id", F.xxhash64("text").alias("k"), let(some, found).alias("x")).select("doc_id", "k", "x.base", "x.tokens")


def telling_words(docs: DataFrame, graph: DataFrame) -> DataFrame:
    """``pattern``: those of one word and any shape whose distinct instances are more than
    chance would put beside the word, by its frequency in all texts (as Poisson counts)."""
    words = stored(docs.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).where("word <> ''")
                   .groupBy("word").agg(F.count(F.lit(1)).alias("c")), "words")
    all_words = words.agg(F.sum("c").alias("all_words"))
    all_instances = graph.agg(F.count_distinct("instance").alias("all_instances"))
    x = F.split("pattern", "\t", -1)
    beside = graph.where((x[2] == "") & ((x[0] == "") | (x[1] == ""))).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= LEAST_SEEDS).withColumn("word", F.concat(x[0], x[1]))
    expected = F.col("c") / F.col("all_words") * F.col("all_instances")
    return stored(beside.join(words, "word").crossJoin(all_words).crossJoin(all_instances)
                  .where(F.col("n") >= expected + TELLING * F.sqrt(expected)).select("pattern"), "telling")


def confident_patterns(graph: DataFrame, telling: DataFrame) -> DataFrame:
    """``pattern, instance, seed`` (one row for each edge) -> the confident patterns."""
    known = graph.where("seed").select("instance").distinct()
    x = F.split("pattern", "\t", -1)
    before, after = (telling.select(F.col("pattern").alias(side)) for side in ("_before", "_after"))
    patterns = None
    for _ in range(ROUNDS):
        rated = graph.join(known.withColumn("known", F.lit(1)), "instance", "left").groupBy("pattern").agg(
            F.count(F.lit(1)).alias("n"), F.count("known").alias("n_known"))
        patterns = stored(rated.where((F.col("n_known") >= LEAST_SEEDS) & (F.col("n_known") / (F.col("n") + 1) >= CONFIDENT))
                          .join(before, F.concat(x[0], F.lit("\t\t")) == F.col("_before"), "left")
                          .join(after, F.concat(F.lit("\t"), x[1], F.lit("\t")) == F.col("_after"), "left")
                          .where(F.col("_before").isNotNull() | F.col("_after").isNotNull() | ((x[0] != "") & (x[1] != "") & (x[2] != "")))
                          .select("pattern"), "patterns")
        known = stored(known.unionByName(graph.join(patterns, "pattern", "left_semi").select("instance")).distinct(), "known")
    return patterns


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, by the order of KINDS and then by start."""
    rank = F.array(*(F.lit(k) for k in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(
        F.array_position(rank, x["kind"]).alias("r"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, k, base, spans`` (``array<struct<kind, s, e>>``); ``spans``
    holds the base ones and the tokens of confident patterns that overlap none of them."""
    seen = stored(scanned(docs), "scanned")
    each = seen.where(F.size("tokens") > 0).select("doc_id", "k", "base", F.explode("tokens").alias("t")) \
        .select("doc_id", "k", "base", "t.s", "t.e", F.lower("t.m").alias("instance"),
                _patterns(F.lower("t.before"), F.lower("t.after"), _shape(F.col("t.m"))).alias("patterns")) \
        .withColumn("seed", F.exists("base", lambda b: (b["s"] < F.col("e")) & (F.col("s") < b["e"])))
    edges = each.select("doc_id", "k", "s", "e", "instance", "seed", F.explode("patterns").alias("pattern"))
    graph = stored(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "graph")
    more = edges.where("not seed").join(confident_patterns(graph, telling_words(docs, graph)), "pattern", "left_semi") \
        .groupBy("doc_id", "k").agg(F.collect_set(F.struct(F.lit("found").alias("kind"), "s", "e")).alias("more"))
    got = more.withColumnsRenamed({"doc_id": "_d", "k": "_k"})
    return seen.join(got, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k")), "left").select(
        "doc_id", "k", "base", F.concat("base", F.coalesce("more", F.array().cast(SPAN))).cast(SPAN).alias("spans"))


def personal_report(docs: DataFrame) -> DataFrame:
    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return find_personal_data(docs).select("doc_id", *(count(k) for k in KINDS[:4]), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                                           joined(F.col("spans")).alias("spans"))
