"""Registered queries: model answers, plug-in stage, sinks, review, streaming, upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from calforge.functions.uid import event_uid_sql
from calforge.operators import calls as CALLS
from calforge.operators import chunks as C
from calforge.operators import events as E
from calforge.operators import extract as X
from calforge.operators import feed as FD
from calforge.plans import calendar_run as RUN
from calforge.plans import fixtures as FX
from calforge.plans import gather as G
from calforge.plans import incremental as INC
from calforge.plans.book import register
from calforge.plans.catalog_text import (EXTRACT_SQL, GATHER_SQL, LISTING_CHUNKS_SQL, _card_pages, _card_text_sql, _extract_lines_sql, _extract_sql,
                                         _gathered, _items_text_sql, _unit_lines_sql, as_long)
from calforge.plans.plugins import LineFormatExtractor, UnsteadyExtractor
from calforge.plans.sqlparts import feed_cte, prepared_cte, with_cte
from calforge.session import scratch_path, stored_table
from calforge.sources import registry as R
from calforge.sources import sinks as S
from calforge.streaming import stream as ST
from calforge.streaming import versions as V
from calforge.streaming.upsert import upsert_events

KEYS = ("source_rank", "source_name", "chunk_idx")

# ============================================================ X6: model answers

FX5_SQL = f"""
SELECT source_rank, source_name, chunk_idx,
  CASE WHEN chunk_idx % 9 = 0 THEN substr(js, 1, 40) || '...' ELSE js END AS response
FROM (
  SELECT source_rank, source_name, chunk_idx,
    '{{"events":' || CASE WHEN chunk_idx % 9 = 4 THEN '[' || '{FX.BAD_EVENT_JSON}' || ',' || substr(arr, 2)
                         ELSE arr END || '}}' AS js
  FROM (SELECT source_rank, source_name, chunk_idx,
               CAST(to_json(list({{'title': title, 'date': date_raw, 'time': coalesce(time_raw, '20:00'),
                                   'location': location, 'category': category_raw,
                                   'description': coalesce(description, '')}} ORDER BY event_idx)) AS VARCHAR) AS arr
        FROM ({FX.FX4_SQL}) c GROUP BY ALL) g) h"""

PARSE_SQL = f"""
WITH r AS ({FX5_SQL}),
v AS (SELECT *, try_cast(response AS JSON) AS j FROM r),
e AS (SELECT *, CASE WHEN json_type(j, '$.events') = 'ARRAY' THEN json_extract(j, '$.events[*]') END AS evs FROM v),
g AS (SELECT * FROM e
      WHERE evs IS NOT NULL AND list_bool_and(list_transform(evs, lambda x:
        coalesce(json_type(x, '$.title') = 'VARCHAR' AND json_type(x, '$.date') = 'VARCHAR'
                 AND json_type(x, '$.time') = 'VARCHAR' AND json_type(x, '$.location') = 'VARCHAR'
                 AND json_type(x, '$.description') = 'VARCHAR' AND json_type(x, '$.category') IS NOT NULL,
                 false))))
SELECT source_rank, source_name, chunk_idx, CAST(i - 1 AS BIGINT) AS event_idx,
       json_extract_string(x, '$.title') AS title, json_extract_string(x, '$.date') AS date_raw,
       json_extract_string(x, '$.time') AS time_raw, json_extract_string(x, '$.location') AS location,
       CASE WHEN json_type(x, '$.category') = 'VARCHAR' THEN json_extract_string(x, '$.category') END AS category_raw,
       json_extract_string(x, '$.description') AS description
FROM (SELECT *, unnest(evs) AS x, generate_subscripts(evs, 1) AS i FROM g) u"""


@register("parse_event_json", PARSE_SQL)
def q_parse_event_json(spark, sf):
    return X.parse_event_json(FX.fx5_responses(spark, sf), KEYS)


# ============================================================ X5: plug-in stage

def _plugin_candidates(spark, sf):
    chunks = G.units_to_chunks(G.listing_units(_card_pages(spark, sf)))
    answers = X.extract_with(chunks, LineFormatExtractor(), KEYS)
    return as_long(X.event_defaults(X.parse_event_json(answers, KEYS)))


@register("extract_events_plugin", EXTRACT_SQL)
def q_extract_events_plugin(spark, sf):
    return _plugin_candidates(spark, sf)


CALLED_SQL = f"""
WITH c AS (SELECT *, md5(chunk) AS m FROM ({LISTING_CHUNKS_SQL}) ch),
f AS (SELECT DISTINCT chunk FROM c WHERE CAST(floor(chunk_idx / {G.CHUNK_STRIDE}) AS BIGINT) % 2 = 0),
s AS (SELECT c.*, f.chunk IS NOT NULL AS in_first, CASE WHEN m[1] IN ('4', '5') THEN 'failed' WHEN m[1] IN ('6', '7') THEN 'invalid'
             ELSE 'ok' END AS status FROM c LEFT JOIN f USING (chunk))
SELECT source_rank, source_name, chunk_idx, status, CASE WHEN m[1] < '8' THEN 2 ELSE 1 END AS attempts,
       CASE WHEN in_first AND status = 'ok' THEN 1 ELSE 2 END AS run FROM s"""


def _called(spark, sf):
    """Two runs over the listing chunks by an unsteady extractor: the pages of even number, then all."""
    chunks = stored_table(as_long(G.units_to_chunks(G.listing_units(_card_pages(spark, sf)))), "listing-chunks")
    store = scratch_path(spark, "answers")
    CALLS.call(chunks.where(F.floor(F.col("chunk_idx") / G.CHUNK_STRIDE) % 2 == 0), UnsteadyExtractor(), store)
    return CALLS.call(chunks, UnsteadyExtractor(), store)


@register("extraction_calls", CALLED_SQL)
def q_extraction_calls(spark, sf):
    return _called(spark, sf).select("source_rank", "source_name", "chunk_idx", "status", "attempts", "run")


@register("extract_events_controlled", f"""
SELECT e.* FROM ({EXTRACT_SQL}) e JOIN ({CALLED_SQL}) c USING (source_rank, source_name, chunk_idx) WHERE c.status = 'ok'""")
def q_extract_events_controlled(spark, sf):
    good = _called(spark, sf).where("status = 'ok'")
    return as_long(X.event_defaults(X.parse_event_json(good, KEYS)))


# ============================================================ SC8 / J6

@register("ics_sink", with_cte(feed_cte(FX.FX4_SQL), "SELECT category, line FROM lines"))
def q_ics_sink(spark, sf):
    path = scratch_path(spark, "ics")
    kept = E.parse_events(FX.fx4_candidates(spark, sf), FX.AS_OF)
    S.ics_sink(FD.build_feed(kept, FX.DTSTAMP), path, single_file=True)
    return S.read_ics_sink(spark, path).select("category", "line")


# lines of the calendars by month: each with a header and footer of its own
MONTH_LINES_SQL = """
SELECT category, month, line FROM (
  SELECT b.category, s.month, b.line FROM body b JOIN (
    SELECT category, source_rank, chunk_idx, event_idx, substr(split_part(line, ':', 2), 1, 6) AS month
    FROM body WHERE line_no = 3) s USING (category, source_rank, chunk_idx, event_idx)
  UNION ALL
  SELECT e.category, m.month, e.line FROM envelope e JOIN (
    SELECT DISTINCT category, substr(split_part(line, ':', 2), 1, 6) AS month FROM body WHERE line_no = 3) m
  USING (category)) u"""


@register("ics_sink_monthly", with_cte(feed_cte(FX.FX4_SQL), MONTH_LINES_SQL))
def q_ics_sink_monthly(spark, sf):
    path = scratch_path(spark, "ics-months")
    kept = E.parse_events(FX.fx4_candidates(spark, sf), FX.AS_OF)
    S.ics_sink(FD.build_months(kept, FX.DTSTAMP), path)
    return S.read_ics_sink(spark, path).select("category", F.col("month").cast("string").alias("month"), "line")


UID_ROWS = f"SELECT {event_uid_sql('title', 'date_raw')} AS uid, event_id, category, title, date_raw FROM win " \
           f"WHERE start_ts IS NOT NULL"


@register("approved_events", with_cte(feed_cte(FX.FX4_SQL), f"""
SELECT uid, event_id, category FROM ({UID_ROWS}) p
WHERE uid IN (SELECT uid FROM ({UID_ROWS}) d WHERE NOT starts_with(lower(title), 'error'))"""))
def q_approved_events(spark, sf):
    pub = FD.published_events(E.parse_events(FX.fx4_candidates(spark, sf), FX.AS_OF))
    decisions = pub.where(~F.lower("title").startswith("error")).select("uid")
    return FD.approved_events(pub, decisions).select("uid", "event_id", "category")


# ============================================================ ST1-ST4

STREAM_COLS = ("chunk_idx", "event_idx", "title", "date_raw", "time_raw", "location", "category", "event_key")

PAGE_UNITS_SQL = f"""
SELECT 0 AS source_rank, 'listing' AS source_name, page, {C.site_envelope_sql("'listing'", 'text')} AS text
FROM (SELECT page, {_card_text_sql('html')} AS text FROM ({FX.FX3_CARDS_SQL}) p) q WHERE text <> ''"""
PAGE_CHUNKS_SQL = f"""
SELECT 0 AS source_rank, 'listing' AS source_name, page * {G.CHUNK_STRIDE} + chunk_idx AS chunk_idx, chunk
FROM ({C.chunk_lines_sql(PAGE_UNITS_SQL, 'page')}) c"""
STREAM_SQL = with_cte(prepared_cte(f"SELECT * FROM ({_extract_sql(PAGE_CHUNKS_SQL)}) e"),
                      f"SELECT {', '.join(STREAM_COLS)}, strftime(event_date, '%Y-%m-%d') AS event_date FROM p")


def _land_card_pages(spark, sf) -> str:
    """Land the listing pages as several Parquet files (the stream's input)."""
    path = scratch_path(spark, "landing-pages")
    n_pages = FX.table(spark, sf, "events").count() // FX.LISTING_PAGE_SIZE
    FX.fx3_card_pages(spark, sf).write.option("maxRecordsPerFile", ST.records_a_file(n_pages, 50)).parquet(path)
    return path


def _stream_out(df):
    return as_long(df).select(*STREAM_COLS, F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))


@register("stream_pages_to_events", STREAM_SQL)
def q_stream_pages_to_events(spark, sf):
    landing = _land_card_pages(spark, sf)
    schema = spark.read.parquet(landing).schema
    stream = ST.page_candidates(ST.read_landing(spark, landing, schema, ST.files_a_batch(spark, landing)))
    out = ST.run_available(_stream_out(stream), spark, "pages-to-events")
    return spark.read.parquet(out)


@register("stream_event_feed", STREAM_SQL)
def q_stream_event_feed(spark, sf):
    landing = _land_card_pages(spark, sf)
    schema = spark.read.parquet(landing).schema
    stream = _stream_out(ST.page_candidates(ST.read_landing(spark, landing, schema, ST.files_a_batch(spark, landing))))
    table = ST.stream_event_feed(stream, spark, scratch_path(spark, "event-feed"))
    return spark.read.parquet(table).drop("batch_id")


@register("stream_dedup", with_cte(prepared_cte(FX.FX4_SQL), "SELECT DISTINCT source_name, event_key FROM p"))
def q_stream_dedup(spark, sf):
    landing = scratch_path(spark, "landing-candidates")
    events = FX.table(spark, sf, "events")
    (events.selectExpr(*FX.FX4_COLUMNS, "ts")
     .write.option("maxRecordsPerFile", ST.records_a_file(events.count(), 4000)).parquet(landing))
    schema = spark.read.parquet(landing).schema
    stream = E.with_event_key(ST.read_landing(spark, landing, schema, ST.files_a_batch(spark, landing)))
    out = ST.run_available(ST.stream_dedup(stream).select("source_name", "event_key"), spark, "dedup")
    return spark.read.parquet(out)


NEW_AS_OF = "2024-01-20"


def _uid_rows_sql(as_of: str, run: int) -> str:
    return "(" + with_cte(feed_cte(FX.FX4_SQL, as_of), f"SELECT *, {run} AS run FROM ({UID_ROWS}) u") + ")"


@register("upsert_events", f"""
SELECT uid, event_id, category, run FROM {_uid_rows_sql(FX.AS_OF, 1)} o
WHERE uid NOT IN (SELECT uid FROM {_uid_rows_sql(NEW_AS_OF, 2)} n1)
UNION ALL
SELECT uid, event_id, category, run FROM {_uid_rows_sql(NEW_AS_OF, 2)} n2""")
def q_upsert_events(spark, sf):
    cand = FX.fx4_candidates(spark, sf)

    def run(as_of, n):
        pub = FD.published_events(E.parse_events(cand, as_of))
        return pub.select("uid", "event_id", "category", F.lit(n).alias("run"))

    return upsert_events(run(FX.AS_OF, 1), run(NEW_AS_OF, 2))


# A second run over changed candidates: new titles (new uids, the old ones vanish), new places
# (same uids), and a later date from which events count.
SECOND_TITLE = "CASE WHEN event_id % 4 = 0 THEN concat(title, ' neu') ELSE title END"
SECOND_PLACE = "CASE WHEN event_id % 4 = 1 THEN concat(location, ' Nord') ELSE location END"
FX4_SECOND_SQL = f"SELECT * REPLACE ({SECOND_TITLE} AS title, {SECOND_PLACE} AS location) FROM ({FX.FX4_SQL}) c4"


def _published_sql(cand_sql: str, as_of: str, run: int) -> str:
    return "(" + with_cte(feed_cte(cand_sql, as_of), f"""
SELECT {event_uid_sql('title', 'date_raw')} AS uid, event_id, category, title, date_raw, location, {run} AS run
FROM win WHERE start_ts IS NOT NULL""") + ")"


@register("stream_upsert", f"""
SELECT * FROM {_published_sql(FX.FX4_SQL, FX.AS_OF, 1)} o WHERE uid NOT IN (SELECT uid FROM {_published_sql(FX4_SECOND_SQL, NEW_AS_OF, 2)} n1)
UNION ALL SELECT * FROM {_published_sql(FX4_SECOND_SQL, NEW_AS_OF, 2)} n2""")
def q_stream_upsert(spark, sf):
    """Two overlapping runs, landed as files and merged batch by batch into a versioned table."""
    cand = FX.fx4_candidates(spark, sf)
    second = cand.withColumns({"title": F.expr(SECOND_TITLE), "location": F.expr(SECOND_PLACE)})
    landing = scratch_path(spark, "landing-runs")
    for n, rows, as_of in ((1, cand, FX.AS_OF), (2, second, NEW_AS_OF)):
        FD.published_events(E.parse_events(rows, as_of)).select(
            "uid", "event_id", "category", "title", "date_raw", "location", F.lit(n).alias("run")).write.mode("append").parquet(landing)
    stream = ST.read_landing(spark, landing, spark.read.parquet(landing).schema, max_files=2)
    return V.current(spark, V.stream_upsert(stream, scratch_path(spark, "events-versions")))


@register("stream_first_wins", with_cte(prepared_cte(FX.FX4_SQL), """
SELECT event_id, source_rank, source_name, chunk_idx, event_idx, event_key, category FROM kept"""))
def q_stream_first_wins(spark, sf):
    """Candidates that land last chunk first, several batches; the next run's first row closes the run."""
    cand = E.drop_past(E.with_event_key(E.with_event_date(E.classify_category(FX.fx4_candidates(spark, sf)))), FX.AS_OF)
    cand = cand.withColumn("run_at", F.lit("2024-01-10 06:00:00").cast("timestamp"))
    landing = scratch_path(spark, "landing-reversed")
    last = cand.agg(F.max("chunk_idx")).first()[0] or 0
    quarter = F.floor(F.col("chunk_idx") * 4 / (last + 1))
    for n in (3, 2, 1, 0):
        cand.where(quarter == n).coalesce(1).write.mode("append").parquet(landing)
    cand.limit(1).withColumn("run_at", F.lit("2024-01-11 06:00:00").cast("timestamp")).coalesce(1).write.mode("append").parquet(landing)
    stream = ST.read_landing(spark, landing, spark.read.parquet(landing).schema, max_files=1)
    out = ST.run_available(V.first_in_order(stream, ("source_rank", "source_name", "event_key")), spark, "first-wins")
    return spark.read.parquet(out).select("event_id", "source_rank", "source_name", "chunk_idx", "event_idx", "event_key", "category")


# ============================================================ whole runs

def _run_dated_sql(i: int, name: str) -> str:
    return f"""
SELECT CAST({FX.RUN_RANK + i} AS BIGINT) AS source_rank, '{name}' AS source_name, page AS chunk_idx,
       event_id % {FX.DATED_PAGE_SIZE} AS event_idx, {FX.FX7_TITLE} AS title, {FX.FX7_DATE} AS date_raw,
       {FX.FX7_TIME} AS time_raw, '{name}' AS location, {FX.FX7_TITLE} AS category_raw, '' AS description
FROM (SELECT *, CAST(floor(event_id / {FX.DATED_PAGE_SIZE}) AS BIGINT) AS page FROM events) ev"""


def _run_listing_sql(i: int, name: str, pages_sql: str, text_sql: str) -> str:
    units = (f"SELECT page, {C.site_envelope_sql(chr(39) + name + chr(39), 'text')} AS text "
             f"FROM (SELECT page, {text_sql} AS text FROM ({pages_sql}) p) q WHERE text <> ''")
    return f"SELECT * FROM ({_extract_lines_sql(_unit_lines_sql(units, f'CAST({FX.RUN_RANK + i} AS BIGINT)', chr(39) + name + chr(39)))}) e"


RUN_CANDIDATES_SQL = " UNION ALL BY NAME ".join([
    _run_listing_sql(0, "cards.example", FX.FX3_CARDS_SQL, _card_text_sql("html")),
    _run_listing_sql(1, "items.example", FX.FX3_ITEMS_SQL, _items_text_sql("html", "'items.example'")),
    *[_run_dated_sql(i, FX.RUN_SOURCES[i][0]) for i in (2, 3, 4)]])


def _run(spark, sf):
    registry, profiles, pages, listings = FX.fx8_run(spark, sf)
    texts = RUN.gather(registry, profiles, pages, listings=listings)
    return texts, RUN.extract_candidates(spark, registry, profiles, pages, FX.AS_OF, texts=texts)


@register("date_line_events", " UNION ALL ".join(
    f"SELECT source_name, title, date_raw, time_raw, location FROM ({_run_dated_sql(i, FX.RUN_SOURCES[i][0])}) d"
    for i in (2, 3, 4)))
def q_date_line_events(spark, sf):
    _, cand = _run(spark, sf)
    return (cand.where(~F.col("source_name").isin("cards.example", "items.example"))
            .select("source_name", "title", "date_raw", "time_raw", "location"))


RUN_CALENDAR_EVENTS = 250


@register("run_calendars", with_cte(feed_cte(f"SELECT CAST(NULL AS BIGINT) AS event_id, * FROM ({RUN_CANDIDATES_SQL}) rc"), f"""
SELECT category, month, line FROM (
  SELECT b.category, s.month, b.line FROM body b JOIN (
    SELECT category, source_rank, chunk_idx, event_idx, substr(split_part(line, ':', 2), 1, 6) AS month
    FROM body WHERE line_no = 3) s USING (category, source_rank, chunk_idx, event_idx)
  UNION ALL
  SELECT e.category, m.month, e.line FROM envelope e JOIN (
    SELECT category, month, unnest(range(0, CAST(ceil(n / {RUN_CALENDAR_EVENTS}) AS BIGINT))) AS piece
    FROM (SELECT category, substr(split_part(line, ':', 2), 1, 6) AS month, count(*) AS n FROM body WHERE line_no = 3 GROUP BY 1, 2) c) m
  USING (category)) u"""))
def q_run_calendars(spark, sf):
    """From registry and pages to the calendar files, several a month, read back."""
    _, cand = _run(spark, sf)
    path = scratch_path(spark, "run-calendars")
    RUN.build_calendars(spark, cand, path, FX.AS_OF, FX.DTSTAMP, events=RUN_CALENDAR_EVENTS)
    return S.read_ics_sink(spark, path).select("category", F.col("month").cast("string").alias("month"), "line")


def _listing_texts_sql(name: str, pages_sql: str, text_sql: str) -> str:
    return f"SELECT '{name}' AS source_name, {text_sql} AS text FROM ({pages_sql}) p"


FX7_TEXTS_SQL = f"""
SELECT string_agg(CASE event_id % 3 WHEN 0 THEN strftime(ts, '%d.%m.%Y, %H:%M Uhr | ') || {FX.FX7_TITLE}
         WHEN 1 THEN {FX.FX7_TITLE} || ' – ' || strftime(ts, '%Y-%m-%d')
         ELSE 'Fr, ' || day(ts) || '.' || month(ts) || '.' || chr(10) || {FX.FX7_TITLE} END, chr(10)) AS text
FROM events GROUP BY CAST(floor(event_id / {FX.DATED_PAGE_SIZE}) AS BIGINT)"""

RUN_REPORT_CTE = prepared_cte(f"SELECT CAST(NULL AS BIGINT) AS event_id, * FROM ({RUN_CANDIDATES_SQL}) rc") + f""",
texts AS (SELECT source_name, coalesce(text, '') AS text FROM ({GATHER_SQL}) g
  UNION ALL {_listing_texts_sql('cards.example', FX.FX3_CARDS_SQL, _card_text_sql('html'))}
  UNION ALL {_listing_texts_sql('items.example', FX.FX3_ITEMS_SQL, _items_text_sql('html', chr(39) + 'items.example' + chr(39)))}
  {''.join(f"UNION ALL SELECT '{n}', text FROM ({FX7_TEXTS_SQL}) t{i} " for i, n in enumerate(('text.example', 'lines.example', 'frames.example')))}),
size AS (SELECT source_name, count(*) FILTER (text <> '') AS n_pages, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM texts GROUP BY 1),
found AS (SELECT source_name, count(*) AS n_candidates, count(*) FILTER (reject_reason = 'invalid_date') AS invalid_date,
                 count(*) FILTER (reject_reason = 'past') AS past, count(*) FILTER (reject_reason = 'duplicate') AS duplicate,
                 count(*) FILTER (reject_reason IS NULL) AS n_events FROM st GROUP BY 1),
per AS (SELECT size.*, coalesce(n_candidates, 0) AS n_candidates, coalesce(invalid_date, 0) AS invalid_date, coalesce(past, 0) AS past,
               coalesce(duplicate, 0) AS duplicate, coalesce(n_events, 0) AS n_events FROM size LEFT JOIN found USING (source_name))"""
RUN_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("n_pages", "n_chars", *RUN.COUNTED, "n_events"))


@register("run_report", with_cte(RUN_REPORT_CTE, f"SELECT source_name, count(*) AS n_sources, {RUN_SUMS} FROM per GROUP BY ROLLUP (source_name)"))
def q_run_report(spark, sf):
    registry, profiles, pages, listings = FX.fx8_run(spark, sf)
    texts = RUN.gather_all(registry, profiles, pages, listings=listings)
    cand = RUN.extract_candidates(spark, registry, profiles, pages, FX.AS_OF, texts=E.gathered_text(texts))
    return RUN.run_report(texts, cand, FX.AS_OF)


RUN_SOURCES_SQL = " UNION ALL ".join([f"SELECT name FROM ({FX.FX1_SQL}) r WHERE coalesce(enabled, false)",
                                      *[f"SELECT '{n}'" for n, _ in FX.RUN_SOURCES], "SELECT 'gone.example'"])


@register("source_report", with_cte(RUN_REPORT_CTE, f"""
SELECT s.name AS source_name, CASE WHEN per.source_name IS NULL THEN 'no page' WHEN n_pages = 0 THEN 'empty text'
         WHEN n_candidates = 0 THEN 'no events' WHEN n_events = 0 THEN 'no upcoming events' ELSE 'ok' END AS status,
       {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('n_pages', 'n_chars', *RUN.COUNTED, 'n_events'))}
FROM ({RUN_SOURCES_SQL}) s LEFT JOIN per ON per.source_name = s.name"""))
def q_source_report(spark, sf):
    """Every enabled source of a run and why it has no events; one of them was never fetched."""
    registry, profiles, pages, listings = FX.fx8_run(spark, sf)
    registry = registry.unionByName(spark.createDataFrame([(-1, "gone.example", "https://gone.example/", True)], registry.schema))
    texts = RUN.gather_all(registry, profiles, pages, listings=listings)
    cand = RUN.extract_candidates(spark, registry, profiles, pages, FX.AS_OF, texts=E.gathered_text(texts))
    return RUN.source_report(R.enabled_sources(registry), texts, cand, FX.AS_OF).drop("n_failed", "error")


@register("gather_totals", f"""
SELECT source_name, count(DISTINCT source_name) AS n_sources, count(*) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM ({GATHER_SQL}) g WHERE coalesce(text, '') <> '' GROUP BY ROLLUP (source_name)""")
def q_gather_totals(spark, sf):
    """A2: sources, pages and characters, per source and in total."""
    return E.gather_totals(E.gathered_text(_gathered(spark, sf)))


@register("incremental_runs", f"""
WITH p AS (SELECT DISTINCT CAST(floor(event_id / {FX.DATED_PAGE_SIZE}) AS BIGINT) AS page FROM events),
c AS (SELECT count(*) AS n, count(*) FILTER (page % 2 = 0) AS n_even, (SELECT count(*) FROM events) AS n_events FROM p),
e AS (SELECT count(*) AS in_even FROM events WHERE CAST(floor(event_id / {FX.DATED_PAGE_SIZE}) AS BIGINT) % 2 = 0)
SELECT 1 AS run, n AS n_texts, n AS n_changed, n_events AS n_extracted, n_events AS n_candidates FROM c
UNION ALL SELECT 2, n, n_even, in_even + n_even, n_events + n_even FROM c, e
UNION ALL SELECT 3, n, 0, 0, n_events + n_even FROM c""")
def q_incremental_runs(spark, sf):
    """Three runs over dated pages: all new; a newer copy of every second page with one more event and
    of every other page with the same text; nothing new."""
    source = [("text.example", "https://text.example/")]
    registry = spark.createDataFrame([(0, *source[0], True)], "rank bigint, name string, url string, enabled boolean")
    profiles = spark.createDataFrame([("text.example", "generic")], "name string, profile string")
    first = FX.fx7_dated_pages(spark, sf).selectExpr("page AS page_id", "concat('https://text.example/', CAST(page AS string)) AS url", "html")
    added = "IF(page_id % 2 = 0, '<p>24.12.2030, 18:00 Uhr | Neu</p>', '<!-- same text -->')"
    newer = first.selectExpr("page_id + 1000000L AS page_id", "url", f"replace(html, '</main>', concat({added}, '</main>')) AS html")
    landed = [scratch_path(spark, f"pages-{n}") for n in (1, 2)]
    first.write.parquet(landed[0])
    newer.write.parquet(landed[1])
    state, out = scratch_path(spark, "incremental"), []
    for n, paths in ((1, landed[:1]), (2, landed), (3, landed)):
        pages = spark.read.parquet(*paths)
        cand, counts = INC.run(spark, registry, profiles, pages, state,
                               listings=pages.selectExpr("'text.example' AS source_name", "url").distinct())
        out.append((n, counts["n_texts"], counts["n_changed"], counts["n_extracted"], cand.count()))
    return spark.createDataFrame(out, "run int, n_texts bigint, n_changed bigint, n_extracted bigint, n_candidates bigint")
