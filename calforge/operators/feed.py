"""Validated events -> calendar lines per category.

Output of ``build_feed`` is a *line table*, one row per output line:
    category STRING, part INT (0 header, 1 events, 2 footer),
    source_rank BIGINT, chunk_idx BIGINT, event_idx BIGINT, line_no INT, line STRING
Sorting by (part, source_rank, chunk_idx, event_idx, line_no) within a category gives
the calendar document. Order stays in columns, so no task ever has to number or
concatenate a whole category; the file sink writes the sorted ranges in parallel.

Check order inside one category follows the reference builder: empty date skipped,
then the global key is claimed, then the start time is parsed. A row whose time does
not parse still claims its key and suppresses later duplicates (the "poison" rule).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.functions.classify import CATEGORIES, bucket, category_rank
from calforge.functions.dates import dtstart_text, parse_start
from calforge.functions.text import capitalize, ics_escape
from calforge.functions.uid import UID_DOMAIN, event_uid
from calforge.operators.events import event_key

LINE_COLS = ("category", "part", "source_rank", "chunk_idx", "event_idx", "line_no", "line")
FEED_ORDER = ("cat_rank", "source_rank", "chunk_idx", "event_idx")

# The calendar text layout (header lines use the capitalised category).
TZID = "Europe/Berlin"
HEADER_TEMPLATE = (
    "BEGIN:VCALENDAR",
    "VERSION:2.0",
    "PRODID:-//Braunschweig Events//{Name}",
    "CALSCALE:GREGORIAN",
    "METHOD:PUBLISH",
    "X-WR-CALNAME:Braunschweig {Name}",
    "X-WR-TIMEZONE:" + TZID,
    "X-WR-CALDESC:Kommende {Name} Events",
)
FOOTER = "END:VCALENDAR"
# Defaults for missing fields in the builder.
DEFAULT_TITLE, DEFAULT_TIME = "Event", "00:00"


def utc_stamp(now: _dt.datetime | None = None) -> str:
    """DTSTAMP text, taken once per build on the driver (UTC)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%SZ")


def publish_projection(df: DataFrame) -> DataFrame:
    """Provenance columns are not part of the calendar."""
    return df.drop("source_url", "source_name")


def approved_events(candidates: DataFrame, decisions: DataFrame, uid_col: str = "uid") -> DataFrame:
    """Only reviewed/approved candidates are published (left-semi join on uid)."""
    return candidates.join(decisions.select(uid_col).where(F.col(uid_col).isNotNull()), uid_col, "left_semi")


def category_bucket(df: DataFrame) -> DataFrame:
    """``category`` -> one of the five buckets, plus its output rank."""
    return df.withColumn("category", bucket("category")).withColumn("cat_rank", category_rank("category"))


def feed_defaults(df: DataFrame) -> DataFrame:
    """a missing (NULL) field takes the builder default."""
    return df.withColumns({
        "title": F.coalesce("title", F.lit(DEFAULT_TITLE)),
        "date_raw": F.coalesce("date_raw", F.lit("")),
        "time_raw": F.coalesce("time_raw", F.lit(DEFAULT_TIME)),
        "description": F.coalesce("description", F.lit("")),
        "location": F.coalesce("location", F.lit("")),
    })


def escape_fields(df: DataFrame) -> DataFrame:
    """escaped title/description/location (description also escapes newlines)."""
    return df.withColumns({
        "title": ics_escape("title"),
        "description": ics_escape("description", newlines=True),
        "location": ics_escape("location"),
    })


def prepare(df: DataFrame) -> DataFrame:
    """F1-F3 plus the global key; rows without date stay (they are counted) but
    carry a NULL key."""
    df = escape_fields(feed_defaults(category_bucket(publish_projection(df))))
    return df.withColumn("feed_key", F.when(F.col("date_raw") != "", event_key("title", "date_raw")))


def dedup_global(prepared: DataFrame) -> DataFrame:
    """across all categories, the first row per key in (cat_rank, input order)
    wins; its start time is parsed afterwards (``start_ts`` NULL = bad time).
    Map-side combined ``min_by`` instead of a window (hot keys stay cheap)."""
    cols = [c for c in prepared.columns if c != "feed_key"]
    winners = (prepared.where(F.col("feed_key").isNotNull())
               .groupBy("feed_key")
               .agg(F.min_by(F.struct(*cols), F.struct(*FEED_ORDER)).alias("_w"))
               .select("_w.*"))
    return winners.withColumn("start_ts", parse_start("date_raw", "time_raw"))


def with_uid(df: DataFrame, domain: str = UID_DOMAIN) -> DataFrame:
    """F6 on prepared (escaped, defaulted) rows."""
    return df.withColumn("uid", event_uid(F.col("title"), F.col("date_raw"), domain))


def uid_of_raw(domain: str = UID_DOMAIN):
    """F6 on unprepared rows: the uid the build will give the event."""
    title = ics_escape(F.coalesce(F.col("title"), F.lit(DEFAULT_TITLE)))
    return event_uid(title, F.coalesce(F.col("date_raw"), F.lit("")), domain)


def event_lines(start, dtstamp) -> Column:
    """the 8 lines of an event, of its ``uid`` and its prepared fields."""
    return F.array(
        F.lit("BEGIN:VEVENT"),
        F.concat(F.lit("UID:"), F.col("uid")),
        F.concat(F.lit("DTSTAMP:"), dtstamp),
        F.concat(F.lit(f"DTSTART;TZID={TZID}:"), start),
        F.concat(F.lit("SUMMARY:"), F.col("title")),
        F.concat(F.lit("DESCRIPTION:"), F.col("description")),
        F.concat(F.lit("LOCATION:"), F.col("location")),
        F.lit("END:VEVENT"),
    )


def ics_events(winners: DataFrame, dtstamp: str, domain: str = UID_DOMAIN) -> DataFrame:
    """The 8-line block of every written event."""
    ev = with_uid(winners.where(F.col("start_ts").isNotNull()), domain)
    return (ev.select("category", F.lit(1).alias("part"),
                      F.col("source_rank").cast("bigint").alias("source_rank"),
                      "chunk_idx",
                      F.col("event_idx").cast("bigint").alias("event_idx"),
                      F.posexplode(event_lines(dtstart_text("start_ts"), F.lit(dtstamp))).alias("line_no", "line")))


def ics_envelope(prepared: DataFrame, keys=("category",)) -> DataFrame:
    """F8: header (8 lines) and footer for every bucket that received at least one
    event, even if none of them survives. One ``distinct`` of a few values (combined
    map-side), then header and footer rows from a single generator."""
    cats = prepared.select(*keys).distinct()
    name = capitalize(F.col("category"))
    rows = [F.struct(F.lit(0).alias("part"), F.lit(i).alias("line_no"),
                     (F.replace(F.lit(t), F.lit("{Name}"), name) if "{Name}" in t else F.lit(t)).alias("line"))
            for i, t in enumerate(HEADER_TEMPLATE)]
    rows.append(F.struct(F.lit(2).alias("part"), F.lit(0).alias("line_no"), F.lit(FOOTER).alias("line")))
    zero = F.lit(0).cast("bigint")
    return (cats.select(*keys, F.explode(F.array(*rows)).alias("_r"))
            .select(*keys, "_r.part", zero.alias("source_rank"), zero.alias("chunk_idx"),
                    zero.alias("event_idx"), "_r.line_no", "_r.line"))


def published_events(events: DataFrame, domain: str = UID_DOMAIN) -> DataFrame:
    """The events a build writes (global winners with a valid start), with uid."""
    return with_uid(dedup_global(prepare(events)).where(F.col("start_ts").isNotNull()), domain)


def build_feed(events: DataFrame, dtstamp: str | None = None, domain: str = UID_DOMAIN) -> DataFrame:
    """events -> line table of all calendars."""
    dtstamp = dtstamp or utc_stamp()
    prepared = prepare(events)
    body = ics_events(dedup_global(prepared), dtstamp, domain)
    return ics_envelope(prepared).unionByName(body).select(*LINE_COLS)


def build_months(events: DataFrame, dtstamp: str | None = None, domain: str = UID_DOMAIN) -> DataFrame:
    """F11 in calendars of a month: one row for each written event, with its start, the month of
    that (``yyyyMM``) and its fields. The sink cuts the months into calendars, renders the lines
    (``event_lines``) and puts each calendar's header and footer around them."""
    ev = with_uid(dedup_global(prepare(events)).where(F.col("start_ts").isNotNull()), domain)
    ev = ev.withColumn("start", dtstart_text("start_ts"))
    return ev.select("category", F.substring("start", 1, 6).alias("month"), "start", F.col("source_rank").cast("bigint").alias("source_rank"),
                     "chunk_idx", F.col("event_idx").cast("bigint").alias("event_idx"), "uid",
                     F.lit(dtstamp or utc_stamp()).alias("dtstamp"), "title", "description", "location")


def ics_document(lines: DataFrame) -> DataFrame:
    """calendar text in ordered segments, one per (category, part, source, chunk).

    Concatenating a category's segments in (part, source_rank, chunk_idx) order with
    '\\n' gives the file. A segment is bounded by one chunk's events, so no group
    grows with the data; the single-file form is what the file sink writes."""
    return (lines.groupBy("category", "part", "source_rank", "chunk_idx")
            .agg(F.expr("listagg(line, '\\n') WITHIN GROUP (ORDER BY event_idx, line_no)").alias("text")))


def feed_counts(events: DataFrame) -> DataFrame:
    """per bucket the pre-dedup size (what the reference reports) and what
    happened to it: no date, lost to a global duplicate, bad start time, written.
    Counts only, no join: global duplicates = dated rows - winners."""
    prepared = prepare(events)
    totals = prepared.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("feed_key").isNull()).alias("no_date"),
    )
    won = dedup_global(prepared).groupBy("category").agg(
        F.count(F.lit(1)).alias("winners"),
        F.count_if(F.col("start_ts").isNull()).alias("bad_time"),
    )
    j = totals.join(won, "category", "left").na.fill(0, ["winners", "bad_time"])
    return j.select(
        "category", "n_events", "no_date",
        (F.col("n_events") - F.col("no_date") - F.col("winners")).alias("global_dup"),
        "bad_time",
        (F.col("winners") - F.col("bad_time")).alias("written"),
    )


__all__ = [
    "CATEGORIES", "LINE_COLS", "approved_events", "build_feed", "build_months", "category_bucket", "dedup_global",
    "escape_fields", "event_lines", "feed_counts", "feed_defaults", "ics_document", "ics_envelope", "ics_events",
    "prepare", "publish_projection", "published_events", "utc_stamp", "with_uid",
]
