"""Incremental runs: only pages whose text is new or changed reach extraction.

State, in one folder on shared storage:

    digests/      versioned table: page_key, digest, run, run_id (the extraction that answers for it)
    candidates/   log of extracted events: page_key, run_id, chunk, event_idx and the event's fields

A page is known by its source and url. Its newest copy is gathered (cheap expressions, no model);
the digest is that of its text, so a change of layout or of noise is none, and a frame counts with
what it shows. Pages that the digests hold with the same digest are not extracted again; their
events come from the log, placed by the page's present position. A run that is lost before its
digests are merged leaves log rows that no digest names, and the next run does its work again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.operators import calls as CALLS
from calforge.operators import events as E
from calforge.operators import extract as X
from calforge.plans import gather as G
from calforge.session import scratch_path, stored_table
from calforge.streaming import versions as V

EVENT_COLS = ("title", "date_raw", "time_raw", "location", "category_raw", "description")


def _stride() -> Column:
    return F.lit(G.CHUNK_STRIDE).cast("decimal(10,0)")


def page_digests(texts: DataFrame) -> DataFrame:
    """``page_key, digest`` of gathered texts (with ``source_name, url, text``)."""
    key = F.sha2(F.concat_ws("\n", "source_name", "url"), 256)
    return texts.withColumn("page_key", key).withColumn("digest", F.sha2("text", 256))


def changed_pages(digests: DataFrame, state: str) -> DataFrame:
    """Rows whose text the state does not hold as the page's last one (null-safe: digests are never null)."""
    spark = digests.sparkSession
    if V.log(spark, f"{state}/digests").isEmpty():
        return digests
    known = V.current(spark, f"{state}/digests", key="page_key").select("page_key", "digest")
    return digests.join(known, ["page_key", "digest"], "left_anti")


def _extract(spark: SparkSession, changed: DataFrame, extractor, policy: CALLS.CallPolicy, answers: str | None) -> DataFrame:
    units = changed.select("source_rank", "source_name", F.col("page_id").alias("page"), "text")
    if extractor is None:
        found = X.extract_native(G.units_to_chunks(units, halo=X.HALO))
    else:
        outcomes = CALLS.call(G.units_to_chunks(units), extractor, answers or scratch_path(spark, "answers"), policy)
        found = X.event_defaults(X.parse_event_json(outcomes.where("status = 'ok'")))
    page = F.floor(F.col("chunk_idx") / _stride())
    placed = found.withColumns({"page_id": page.cast("bigint"), "chunk": (F.col("chunk_idx") - page * _stride()).cast("bigint")})
    return placed.join(changed.select("source_name", "page_id", "page_key"), ["source_name", "page_id"])


def run(spark: SparkSession, registry: DataFrame, profiles: DataFrame, pages: DataFrame, state: str, extractor=None,
        listings: DataFrame | None = None, policy: CALLS.CallPolicy = CALLS.CallPolicy(), answers: str | None = None) -> tuple[DataFrame, dict]:
    """One run over the page table as it is now. Returns the candidates of all its pages (those a
    full run would give) and counts: pages with text, pages extracted, events extracted."""
    texts = stored_table(page_digests(E.gathered_text(G.site_texts(registry, profiles, pages, listings=listings, keep_url=True))), "texts")
    changed = stored_table(changed_pages(texts, state), "changed-texts")
    run_id = uuid.uuid4().hex
    n_changed, n_events = changed.count(), 0
    if n_changed:
        found = _extract(spark, changed, extractor, policy, answers).select("page_key", F.lit(run_id).alias("run_id"), "chunk", "event_idx", *EVENT_COLS)
        found.write.mode("append").parquet(f"{state}/candidates")
        n_events = spark.read.parquet(f"{state}/candidates").where(F.col("run_id") == run_id).count()
        last = V.log(spark, f"{state}/digests").agg(F.max("version")).first()[0]
        number = 0 if last is None else last + 1
        V.merge(changed.select("page_key", "digest", F.lit(number).alias("run"), F.lit(run_id).alias("run_id")),
                f"{state}/digests", run_id, key="page_key")
    counts = {"n_texts": texts.count(), "n_changed": n_changed, "n_extracted": n_events}
    if not n_changed and V.log(spark, f"{state}/digests").isEmpty():
        return spark.createDataFrame([], "source_rank bigint, source_name string, chunk_idx decimal(30,0), event_idx bigint, "
                                     + ", ".join(f"{c} string" for c in (*EVENT_COLS, "source_url"))), counts
    # the pages of this run, each with the extraction that answers for its text
    digests = V.current(spark, f"{state}/digests", key="page_key").select("page_key", "run_id")
    now = texts.select("page_key", "source_rank", "source_name", "page_id").join(digests, "page_key")
    log = spark.read.parquet(f"{state}/candidates").join(now, ["page_key", "run_id"])
    place = (F.col("page_id").cast("decimal(20,0)") * _stride() + F.col("chunk")).cast("decimal(30,0)")
    cand = log.select("source_rank", "source_name", place.alias("chunk_idx"), "event_idx", *EVENT_COLS)
    return E.provenance(cand, registry), counts
