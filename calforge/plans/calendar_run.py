"""End-to-end run: what a user of the reference runs (gather + extract, then build).

    candidates = extract_candidates(spark, registry, profiles, pages, as_of=...)
    summary    = build_calendars(spark, candidates, out_dir, as_of=...)

Stage outputs that are expensive to recompute (the extraction answers) are written
as Parquet tables into the shared folder and read back: that cuts the lineage, lets a
later step read them twice without re-running the model, and survives the loss of
executors (a lost task re-reads files instead of re-running extraction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.operators import calls as CALLS
from calforge.operators import events as E
from calforge.operators import extract as X
from calforge.operators import feed as FD
from calforge.plans import gather as G
from calforge.session import evenly, scratch_path
from calforge.sources import sinks as S

KEYS = ("source_rank", "source_name", "chunk_idx")


def materialize(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder (or ``path``) and read it back."""
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def gather_all(registry: DataFrame, profiles: DataFrame, pages: DataFrame, override: DataFrame | None = None,
               listings: DataFrame | None = None) -> DataFrame:
    """The texts of all sources' pages, empty ones too, with their size (J3), stored: extraction and
    the report read them, and the patterns run once for each page."""
    texts = G.site_texts(registry, profiles, pages, override, listings=listings).withColumn("text", F.coalesce("text", F.lit("")))
    return materialize(pages.sparkSession, texts.withColumn("n_chars", F.length("text")), "site-texts")


def gather(registry: DataFrame, profiles: DataFrame, pages: DataFrame, override: DataFrame | None = None,
           listings: DataFrame | None = None) -> DataFrame:
    """The non-empty texts of ``gather_all``."""
    return E.gathered_text(gather_all(registry, profiles, pages, override, listings))


def extract_candidates(spark: SparkSession, registry: DataFrame, profiles: DataFrame, pages: DataFrame,
                       as_of, extractor: X.Extractor | None = None, override: DataFrame | None = None,
                       path: str | None = None, listings: DataFrame | None = None,
                       texts: DataFrame | None = None, policy: CALLS.CallPolicy = CALLS.CallPolicy(),
                       answers: str | None = None, calls_path: str | None = None) -> DataFrame:
    """Gather site texts (all pages of the sources that ``listings`` names; or those given in
    ``texts``), envelope and chunk them, extract candidate events (native or with a plug-in
    ``extractor``), attach each source's url (J4), and store the candidates.

    Calls of an ``extractor`` go by ``policy``. Their answers are kept in the store ``answers`` (a
    rerun with the same folder calls only for chunks without a good one), and what became of each
    chunk is written to ``calls_path``; both are fresh folders of this run unless named."""
    texts = gather(registry, profiles, pages, override, listings) if texts is None else texts
    units = evenly(texts.select("source_rank", "source_name", F.col("page_id").alias("page"), "text"), "source_name", "page")
    if extractor is None:
        cand = X.extract_native(G.units_to_chunks(units, halo=X.HALO))
    else:
        outcomes = CALLS.call(G.units_to_chunks(units), extractor, answers or scratch_path(spark, "answers"), policy, KEYS)
        outcomes = materialize(spark, outcomes, "extraction-calls", calls_path)
        cand = X.event_defaults(X.parse_event_json(outcomes.where("status = 'ok'"), KEYS))
    return materialize(spark, E.provenance(cand, registry), "candidates", path)


def build_calendars(spark: SparkSession, candidates: DataFrame, out_dir: str, as_of,
                    dtstamp: str | None = None, approved: DataFrame | None = None,
                    single_file: bool = False, pieces: int | None = None,
                    events: int = S.EVENTS_PER_CALENDAR) -> DataFrame:
    """Validate and de-duplicate (E8), optionally keep only approved uids (J6), render and
    write the calendars (F11 + SC8: by month, in calendars of about ``events`` events, or one file
    per category). Returns the
    per-category counts (F10)."""
    kept = E.parse_events(candidates, as_of)
    if approved is not None:
        kept = FD.approved_events(kept.withColumn("uid", FD.uid_of_raw()), approved).drop("uid")
    kept = materialize(spark, kept, "kept-events")
    build = FD.build_feed if single_file else FD.build_months
    S.ics_sink(build(kept, dtstamp), out_dir, single_file, pieces, events)
    return FD.feed_counts(kept)


COUNTED = ("n_candidates", "invalid_date", "past", "duplicate")


def _per_source(texts: DataFrame, candidates: DataFrame, as_of) -> DataFrame:
    """Pages, characters, candidates and rejects of each source that has a text."""
    size = texts.groupBy("source_name").agg(F.count_if(F.col("n_chars") > 0).alias("n_pages"), F.sum("n_chars").alias("n_chars"))
    found = candidates.groupBy("source_name").agg(F.count(F.lit(1)).alias("n_candidates"))
    reason = E.event_rejects(candidates, as_of).groupBy("source_name").agg(
        *[F.count_if(F.col("reject_reason") == r).alias(r) for r in COUNTED[1:]])
    per = size.join(found, "source_name", "left").join(reason, "source_name", "left").na.fill(0, list(COUNTED))
    return per.withColumn("n_events", F.col("n_candidates") - F.col("invalid_date") - F.col("past") - F.col("duplicate"))


def run_report(texts: DataFrame, candidates: DataFrame, as_of) -> DataFrame:
    """What a run did, per source and in total (``source_name`` NULL): sources, pages and
    characters of text, candidates, events kept and each kind of reject (E7, A1, A2).
    Sums of two map-side combined aggregates; a source without candidates shows zeros."""
    sums = ("n_pages", "n_chars", *COUNTED, "n_events")
    return _per_source(texts, candidates, as_of).rollup("source_name").agg(
        F.count(F.lit(1)).alias("n_sources"), *[F.sum(c).alias(c) for c in sums])


def source_report(sources: DataFrame, texts: DataFrame, candidates: DataFrame, as_of, outcomes: DataFrame | None = None,
                  path: str | None = None) -> DataFrame:
    """One written row for every enabled source (``name``) of a run, with the counts of
    ``run_report`` and why it has no events, if it has none:

    ``no page`` (nothing fetched), ``empty text`` (no page has any), ``extraction failed`` (no call
    of ``outcomes`` gave an answer; ``error`` is the first message), ``no events`` (none found),
    ``no upcoming events`` (all rejected), else ``ok``. ``texts`` holds empty ones too (``gather_all``)."""
    per = _per_source(texts, candidates, as_of).withColumn("_fetched", F.lit(True))
    rows = sources.select(F.col("name").alias("source_name")).distinct().join(per, "source_name", "left")
    if outcomes is None:
        rows = rows.withColumns({"n_failed": F.lit(0).cast("bigint"), "_ok": F.lit(None).cast("bigint"), "error": F.lit(None).cast("string")})
    else:
        calls = outcomes.groupBy("source_name").agg(
            F.count_if(F.col("status") != "ok").alias("n_failed"), F.count_if(F.col("status") == "ok").alias("_ok"),
            F.min_by(F.coalesce("error", "status"), F.when(F.col("status") != "ok", F.col("chunk_idx"))).alias("error"))
        rows = rows.join(calls, "source_name", "left")
    status = (F.when(F.col("_fetched").isNull(), "no page").when(F.col("n_pages") == 0, "empty text")
              .when((F.col("_ok") == 0) & (F.col("n_failed") > 0), "extraction failed").when(F.col("n_candidates") == 0, "no events")
              .when(F.col("n_events") == 0, "no upcoming events").otherwise("ok"))
    counts = ("n_pages", "n_chars", *COUNTED, "n_events", "n_failed")
    report = rows.withColumn("status", status).na.fill(0, list(counts)).select("source_name", "status", *counts, "error")
    return materialize(sources.sparkSession, report, "source-report", path)
