"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads whole driver tables (or fixture
views Spark derives from them). Output columns are aliased identically on both
sides; dates/timestamps are rendered as text so both engines hash the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.functions.dates import dtstart_text, dtstart_text_sql, wall_clock_text
from calforge.functions.uid import event_uid_sql
from calforge.operators import events as E
from calforge.operators import feed as FD
from calforge.plans import fixtures as FX
from calforge.plans.sqlparts import FEED_CTE, PREPARED_CTE, with_cte

from calforge.plans.book import register


def _d(col: str) -> F.Column:
    return F.date_format(F.col(col), "yyyy-MM-dd")


def _ts(col: str) -> F.Column:
    return wall_clock_text(col)


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return E.parse_events(FX.fx4_candidates(spark, sf), FX.AS_OF)


# ============================================================ E: validation / dedup

@register("classify_category", with_cte(PREPARED_CTE, "SELECT event_id, category_raw, category FROM p"))
def q_classify_category(spark, sf):
    return E.classify_category(FX.fx4_candidates(spark, sf)).select("event_id", "category_raw", "category")


@register("category_enum", with_cte(PREPARED_CTE, """
SELECT category, count(*) AS n_events FROM p
WHERE category IN ('party', 'kultur', 'musik', 'theater', 'sonstiges') GROUP BY category"""))
def q_category_enum(spark, sf):
    df = E.category_enum(E.classify_category(FX.fx4_candidates(spark, sf)))
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("n_events"))


@register("parse_event_date", with_cte(PREPARED_CTE,
          "SELECT event_id, date_raw, strftime(event_date, '%Y-%m-%d') AS event_date FROM p"))
def q_parse_event_date(spark, sf):
    df = E.with_event_date(FX.fx4_candidates(spark, sf))
    return df.select("event_id", "date_raw", _d("event_date").alias("event_date"))


@register("drop_past", with_cte(PREPARED_CTE, f"""
SELECT event_id, strftime(event_date, '%Y-%m-%d') AS event_date FROM p WHERE event_date >= DATE '{FX.AS_OF}'"""))
def q_drop_past(spark, sf):
    df = E.drop_past(E.with_event_date(FX.fx4_candidates(spark, sf)), FX.AS_OF)
    return df.select("event_id", _d("event_date").alias("event_date"))


@register("event_key", with_cte(PREPARED_CTE, "SELECT event_id, event_key FROM p"))
def q_event_key(spark, sf):
    return E.with_event_key(FX.fx4_candidates(spark, sf)).select("event_id", "event_key")


@register("dedup_within_source", with_cte(PREPARED_CTE, """
SELECT event_id, source_rank, source_name, chunk_idx, event_idx, event_key, category FROM kept"""))
def q_dedup_within_source(spark, sf):
    return (E.dedup_within_source(FX.fx4_candidates(spark, sf), FX.AS_OF)
            .select("event_id", "source_rank", "source_name", "chunk_idx", "event_idx", "event_key", "category"))


@register("event_rejects", with_cte(PREPARED_CTE, """
SELECT source_rank, source_name, chunk_idx, event_idx, title, date_raw, category, reject_reason
FROM st WHERE reject_reason IS NOT NULL"""))
def q_event_rejects(spark, sf):
    return E.event_rejects(FX.fx4_candidates(spark, sf), FX.AS_OF)


@register("parse_events", with_cte(PREPARED_CTE, """
SELECT event_id, source_rank, source_name, chunk_idx, event_idx, title, date_raw, time_raw, location,
       category, strftime(event_date, '%Y-%m-%d') AS event_date FROM kept"""))
def q_parse_events(spark, sf):
    return _kept(spark, sf).select("event_id", "source_rank", "source_name", "chunk_idx", "event_idx", "title",
                                   "date_raw", "time_raw", "location", "category", _d("event_date").alias("event_date"))


@register("funnel_counts", with_cte(PREPARED_CTE, """
SELECT category, CAST(count_if(reject_reason = 'invalid_date') AS BIGINT) AS invalid_date,
       CAST(count_if(reject_reason = 'past') AS BIGINT) AS past,
       CAST(count_if(reject_reason = 'duplicate') AS BIGINT) AS duplicate,
       CAST(count_if(reject_reason IS NULL) AS BIGINT) AS kept
FROM st GROUP BY category"""))
def q_funnel_counts(spark, sf):
    return E.funnel_counts(FX.fx4_candidates(spark, sf), FX.AS_OF)


@register("events_per_source", with_cte(PREPARED_CTE, """
SELECT s.source_rank, s.source_name, coalesce(k.n, 0) AS n_events
FROM (SELECT DISTINCT source_rank, source_name FROM c) s
LEFT JOIN (SELECT source_rank, source_name, count(*) AS n FROM kept GROUP BY ALL) k
  USING (source_rank, source_name)"""))
def q_events_per_source(spark, sf):
    cand = FX.fx4_candidates(spark, sf)
    return E.events_per_source(E.parse_events(cand, FX.AS_OF), cand.select(*E.SOURCE_COLS).distinct())


@register("run_summary", with_cte(PREPARED_CTE, """
SELECT source_name, category, count(*) AS n_events, CAST(grouping(source_name, category) AS BIGINT) AS level
FROM kept GROUP BY ROLLUP (source_name, category)"""))
def q_run_summary(spark, sf):
    return E.run_summary(_kept(spark, sf)).withColumn("level", F.col("level").cast("bigint"))


# ============================================================ F: feed

@register("category_bucket", with_cte(FEED_CTE, "SELECT event_id, category, cat_rank FROM fp"))
def q_category_bucket(spark, sf):
    return FD.category_bucket(_kept(spark, sf)).select("event_id", "category", "cat_rank")


@register("feed_defaults", with_cte(FEED_CTE, """
SELECT event_id, coalesce(title, 'Event') AS title, coalesce(date_raw, '') AS date_raw,
       coalesce(time_raw, '00:00') AS time_raw, coalesce(description, '') AS description,
       coalesce(location, '') AS location FROM kept"""))
def q_feed_defaults(spark, sf):
    return FD.feed_defaults(_kept(spark, sf)).select("event_id", "title", "date_raw", "time_raw", "description",
                                                     "location")


@register("ics_escape", with_cte(FEED_CTE, "SELECT event_id, title, description, location FROM fp"))
def q_ics_escape(spark, sf):
    return FD.prepare(_kept(spark, sf)).select("event_id", "title", "description", "location")


@register("dedup_global", with_cte(FEED_CTE, """
SELECT feed_key, event_id, category, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_ts FROM win"""))
def q_dedup_global(spark, sf):
    w = FD.dedup_global(FD.prepare(_kept(spark, sf)))
    return w.select(FD.event_key("title", "date_raw").alias("feed_key"), "event_id", "category",
                    _ts("start_ts").alias("start_ts"))


@register("event_start", with_cte(FEED_CTE, f"""
SELECT event_id, {dtstart_text_sql('start_ts')} AS dtstart FROM win WHERE start_ts IS NOT NULL"""))
def q_event_start(spark, sf):
    w = FD.dedup_global(FD.prepare(_kept(spark, sf)))
    return w.where(F.col("start_ts").isNotNull()).select("event_id", dtstart_text("start_ts").alias("dtstart"))


@register("event_uid", with_cte(FEED_CTE, f"""
SELECT event_id, {event_uid_sql('title', 'date_raw')} AS uid FROM win WHERE start_ts IS NOT NULL"""))
def q_event_uid(spark, sf):
    w = FD.dedup_global(FD.prepare(_kept(spark, sf)))
    return FD.with_uid(w.where(F.col("start_ts").isNotNull())).select("event_id", "uid")


@register("ics_events", with_cte(FEED_CTE, "SELECT * FROM body"))
def q_ics_events(spark, sf):
    return FD.ics_events(FD.dedup_global(FD.prepare(_kept(spark, sf))), FX.DTSTAMP)


@register("ics_envelope", with_cte(FEED_CTE, "SELECT * FROM envelope"))
def q_ics_envelope(spark, sf):
    return FD.ics_envelope(FD.prepare(_kept(spark, sf)))


@register("build_feed", with_cte(FEED_CTE, "SELECT * FROM lines"))
def q_build_feed(spark, sf):
    return FD.build_feed(_kept(spark, sf), FX.DTSTAMP)


@register("ics_document", with_cte(FEED_CTE, """
SELECT category, part, source_rank, chunk_idx, string_agg(line, chr(10) ORDER BY event_idx, line_no) AS text
FROM lines GROUP BY ALL"""))
def q_ics_document(spark, sf):
    return FD.ics_document(FD.build_feed(_kept(spark, sf), FX.DTSTAMP))


@register("feed_counts", with_cte(FEED_CTE, """
SELECT t.category, t.n_events, CAST(t.no_date AS BIGINT) AS no_date,
       CAST(t.n_events - t.no_date - coalesce(w.winners, 0) AS BIGINT) AS global_dup,
       CAST(coalesce(w.bad_time, 0) AS BIGINT) AS bad_time,
       CAST(coalesce(w.winners, 0) - coalesce(w.bad_time, 0) AS BIGINT) AS written
FROM (SELECT category, count(*) AS n_events, count_if(feed_key IS NULL) AS no_date FROM fk GROUP BY category) t
LEFT JOIN (SELECT category, count(*) AS winners, count_if(start_ts IS NULL) AS bad_time FROM win GROUP BY category) w
USING (category)"""))
def q_feed_counts(spark, sf):
    return FD.feed_counts(_kept(spark, sf))


@register("publish_projection", with_cte(FEED_CTE, """
SELECT event_id, source_rank, chunk_idx, event_idx, title, date_raw, time_raw, location, category FROM kept"""))
def q_publish_projection(spark, sf):
    df = FD.publish_projection(_kept(spark, sf).withColumn("source_url", F.lit("")))
    return df.select("event_id", "source_rank", "chunk_idx", "event_idx", "title", "date_raw", "time_raw",
                     "location", "category")

