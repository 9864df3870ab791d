"""Candidate events -> validated, classified, de-duplicated events.

Input columns (candidate events):
    source_rank BIGINT, source_name STRING, chunk_idx BIGINT, event_idx BIGINT,
    title, date_raw, time_raw, location, category_raw, description STRING
Order is meaningful: within a source, events come in (chunk_idx, event_idx) order and
the first occurrence of a key wins. Order is carried in columns, never taken from
partition order.

First-wins is planned as an aggregate, not as ``row_number`` over a window: a window
sorts every row of a key inside one task, so one hot key (say a third of all rows)
would serialise the job. ``min_by``/``min`` aggregates combine map-side, so a hot key
shrinks to one row per map task before the shuffle. Where every row needs its status
(rejects), the per-key winner is joined back; AQE's skew-join handling splits a hot
key's partition on the big side (the winner side has one row per key).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.functions.classify import CATEGORIES, classify_label, label
from calforge.functions.dates import parse_date
from calforge.functions.text import ustrip
from calforge.sources.lookup import few

ORDER_COLS = ("chunk_idx", "event_idx")
SOURCE_COLS = ("source_rank", "source_name")
#: Registry entries that are sent to every task.
MOST_URLS = 100_000


def _lit_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def event_key(title="title", date="date_raw") -> Column:
    """Dedup key ``lower(title).strip() + '-' + raw date`` (the raw date string, so
    '2026-3-7' and '2026-03-07' are different keys)."""
    t = F.col(title) if isinstance(title, str) else title
    d = F.col(date) if isinstance(date, str) else date
    return F.concat(ustrip(F.lower(F.coalesce(t, F.lit("")))), F.lit("-"), F.coalesce(d, F.lit("")))


# -- E1/E2 ---------------------------------------------------------------------------

def classify_category(df: DataFrame, src: str = "category_raw", out: str = "category", rules=None) -> DataFrame:
    """Category from free text (NULL -> 'sonstiges'). The stripped label is a
    column of its own, so the strip runs once per row and the rule chain stays small
    enough for whole-stage codegen."""
    lab = df.withColumn("_label", label(src))
    expr = classify_label("_label") if rules is None else classify_label("_label", rules)
    return lab.withColumn(out, expr).drop("_label")


def category_enum(df: DataFrame, col: str = "category") -> DataFrame:
    """Rows whose category is one of the five buckets (all rows after E1)."""
    return df.where(F.col(col).isin(*CATEGORIES))


# -- E3/E4/E5 ------------------------------------------------------------------------

def with_event_date(df: DataFrame, src: str = "date_raw") -> DataFrame:
    """``event_date`` DATE, NULL when the raw date is not a valid YYYY-M-D."""
    return df.withColumn("event_date", parse_date(src))


def drop_past(df: DataFrame, as_of) -> DataFrame:
    """Keep dated events on or after ``as_of`` (today is kept)."""
    return df.where(F.col("event_date") >= _lit_date(as_of))


def with_event_key(df: DataFrame) -> DataFrame:
    """E5."""
    return df.withColumn("event_key", event_key())


def _prepared(df: DataFrame) -> DataFrame:
    if "category" not in df.columns:
        df = classify_category(df)
    if "event_date" not in df.columns:
        df = with_event_date(df)
    if "event_key" not in df.columns:
        df = with_event_key(df)
    return df


def _eligible(df: DataFrame, as_of) -> Column:
    return F.col("event_date").isNotNull() & (F.col("event_date") >= _lit_date(as_of))


# -- E6/E7/E8 ------------------------------------------------------------------------

def dedup_within_source(df: DataFrame, as_of) -> DataFrame:
    """First event per (source, key) by (chunk_idx, event_idx), among dated,
    upcoming events. One aggregate with map-side combine; one row per kept event."""
    df = _prepared(df)
    cols = df.columns
    keys = [*SOURCE_COLS, "event_key"]
    payload = [c for c in cols if c not in keys]
    kept = (df.where(_eligible(df, as_of))
              .groupBy(*keys)
              .agg(F.min_by(F.struct(*payload), F.struct(*ORDER_COLS)).alias("_e")))
    return kept.select(*keys, "_e.*").select(*cols)


def parse_events(df: DataFrame, as_of) -> DataFrame:
    """E8 (kept side): classify -> parse date -> drop past -> first-wins per source."""
    return dedup_within_source(df, as_of)


def event_status(df: DataFrame, as_of) -> DataFrame:
    """E7/E8 with every row kept and a ``reject_reason`` (NULL = kept); reason
    precedence invalid_date -> past -> duplicate. Reads ``df`` twice (winners
    aggregate + join back); materialise an expensive upstream first."""
    df = _prepared(df)
    keys = [*SOURCE_COLS, "event_key"]
    firsts = (df.where(_eligible(df, as_of))
                .groupBy(*keys)
                .agg(F.min(F.struct(*ORDER_COLS)).alias("_first")))
    joined = df.join(firsts, on=keys, how="left")
    reason = (F.when(F.col("event_date").isNull(), F.lit("invalid_date"))
               .when(F.col("event_date") < _lit_date(as_of), F.lit("past"))
               .when(F.struct(*ORDER_COLS) != F.col("_first"), F.lit("duplicate")))
    return joined.withColumn("reject_reason", reason).drop("_first").select(*df.columns, "reject_reason")


def event_rejects(df: DataFrame, as_of) -> DataFrame:
    """The dropped events with their cause."""
    return (event_status(df, as_of).where(F.col("reject_reason").isNotNull())
            .select(*SOURCE_COLS, *ORDER_COLS, "title", "date_raw", "category", "reject_reason"))


def funnel_counts(df: DataFrame, as_of) -> DataFrame:
    """E8 counts by category: invalid_date / past / duplicate / kept.

    No join: duplicates = eligible - kept, and kept comes from the winners aggregate.
    """
    df = _prepared(df)
    elig = _eligible(df, as_of)
    row_counts = df.groupBy("category").agg(
        F.count_if(F.col("event_date").isNull()).alias("invalid_date"),
        F.count_if(F.col("event_date") < _lit_date(as_of)).alias("past"),
        F.count_if(elig).alias("eligible"),
    )
    kept = dedup_within_source(df, as_of).groupBy("category").agg(F.count(F.lit(1)).alias("kept"))
    return (row_counts.join(kept, "category", "left")
            .select("category", "invalid_date", "past",
                    (F.col("eligible") - F.coalesce(F.col("kept"), F.lit(0))).alias("duplicate"),
                    F.coalesce(F.col("kept"), F.lit(0)).alias("kept")))


# -- A1/A2 ---------------------------------------------------------------------------

def events_per_source(events: DataFrame, sources: DataFrame) -> DataFrame:
    """A1: valid events per gathered source, zero included (right side = sources)."""
    counts = events.groupBy(*SOURCE_COLS).agg(F.count(F.lit(1)).alias("n_events"))
    return (sources.select(*SOURCE_COLS).join(counts, list(SOURCE_COLS), "left")
            .select(*SOURCE_COLS, F.coalesce(F.col("n_events"), F.lit(0)).alias("n_events")))


def run_summary(events: DataFrame) -> DataFrame:
    """A2: totals and detail in one pass: rollup(source_name, category)."""
    return (events.rollup("source_name", "category")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.grouping_id().alias("level")))


def gather_totals(texts: DataFrame) -> DataFrame:
    """A2 on the gathered side: sources, pages and characters of text, for every source and
    in total (``source_name`` NULL). One row per source before the totals."""
    per = texts.groupBy("source_name").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n_chars").alias("n_chars"))
    return per.rollup("source_name").agg(F.count(F.lit(1)).alias("n_sources"), F.sum("n_pages").alias("n_pages"),
                                         F.sum("n_chars").alias("n_chars"))


# -- J3/J4/J5 ------------------------------------------------------------------------

def gathered_text(site_text: DataFrame) -> DataFrame:
    """Keep non-empty texts and report their size in characters."""
    return (site_text.where(F.coalesce(F.col("text"), F.lit("")) != "")
            .withColumn("n_chars", F.length("text")))


def provenance(events: DataFrame, registry: DataFrame, most: int = MOST_URLS) -> DataFrame:
    """Attach ``source_url`` by source name; on repeated names the last registry
    entry wins; a miss gives ''. The url map is one row per name (aggregate). A registry of at
    most ``most`` entries (counted) is sent to every task: by name, the events of a few large
    sources would go to as few tasks. A longer one is joined as AQE plans it."""
    urls = (registry.groupBy(F.col("name").alias("source_name"))
            .agg(F.max_by("url", "rank").alias("source_url")))
    if few(registry, most):
        urls = F.broadcast(urls)
    return (events.join(urls, "source_name", "left")
            .withColumn("source_url", F.coalesce(F.col("source_url"), F.lit(""))))


def events_union(*frames: DataFrame) -> DataFrame:
    """UNION ALL of event lists (no dedup)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
