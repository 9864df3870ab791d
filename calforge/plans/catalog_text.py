"""Registered queries for sources, html/text, listings, chunking and extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from calforge.functions import html as H
from calforge.functions.dates import wall_clock_text
from calforge.functions.text import normalise_lines_sql
from calforge.operators import chunks as C
from calforge.operators import events as E
from calforge.operators import extract as X
from calforge.operators import feed as FD
from calforge.operators import html as HT
from calforge.operators import listing as L
from calforge.plans import fixtures as FX
from calforge.plans import gather as G
from calforge.plans.book import register
from calforge.plans.sqlparts import feed_cte, with_cte
from calforge.session import scratch_path
from calforge.sources import pages as P
from calforge.sources import registry as R
from calforge.sources import sinks as S

ARTICLE = (("article", None),)
LISTING_SOURCE = ("0 AS source_rank", "'listing' AS source_name")


# ============================================================ SC: registry and pages

@register("source_registry", FX.FX1_SQL)
def q_source_registry(spark, sf):
    return FX.fx1_registry(spark, sf)


@register("source_names", f"SELECT rank, name FROM ({FX.FX1_SQL}) r WHERE coalesce(name, '') <> ''")
def q_source_names(spark, sf):
    return R.source_names(FX.fx1_registry(spark, sf))


@register("page_scan", "SELECT page_id, url, html FROM pages WHERE html IS NOT NULL AND html <> ''")
def q_page_scan(spark, sf):
    return P.page_scan(spark, f"{sf}/pages.parquet")


HOST_SQL = f"regexp_extract(url, '{P.URL_HOST_RE}', 1)"


@register("current_page", f"""
SELECT {HOST_SQL} AS host, max(page_id) AS page_id, arg_max(url, page_id) AS url, arg_max(html, page_id) AS html
FROM pages WHERE html <> '' GROUP BY 1""")
def q_current_page(spark, sf):
    return P.current_page(P.page_scan(spark, f"{sf}/pages.parquet"))


@register("multi_page_union", f"""
SELECT r.name AS source_name, r.url, p.page_id
FROM (SELECT name, url FROM ({FX.FX1_SQL}) x
      UNION ALL SELECT name, url || '#missing' FROM ({FX.FX1_SQL}) y) r
JOIN pages p ON p.url = r.url""")
def q_multi_page_union(spark, sf):
    reg = FX.fx1_registry(spark, sf)
    urls = P.union_all([reg.select(F.col("name").alias("source_name"), "url"),
                        reg.select(F.col("name").alias("source_name"), F.concat("url", F.lit("#missing")).alias("url"))])
    return P.multi_page_union(urls, FX.table(spark, sf, "pages").select("page_id", "url", "html")).select(
        "source_name", "url", "page_id")


# The oracle's own, plainer patterns: the frames of the fixture are well-formed.
IFRAME_TAG_RE = r"(?is)<iframe\b([^>]*)>"
SRC_ATTR_RE = r"""(?is)(?:^|[\s"\x27])src="([^"]*)\""""


def _frame_url_sql(html: str, url: str) -> str:
    attrs = f"regexp_extract({html}, '{IFRAME_TAG_RE}', 1)"
    src = (f"CASE WHEN regexp_matches({html}, '{IFRAME_TAG_RE}') AND regexp_matches({attrs}, '{SRC_ATTR_RE}') "
           f"THEN nullif(regexp_extract({attrs}, '{SRC_ATTR_RE}', 1), '') END")
    root = f"regexp_extract({url}, '{P.URL_ROOT_RE}', 1)"
    return (f"CASE WHEN starts_with({src}, 'http') THEN {src} WHEN starts_with({src}, '/') THEN {root} || {src} "
            f"WHEN {src} IS NOT NULL THEN {root} || '/' || {src} END")


FRAME_SQL = f"""
WITH fp AS ({FX.FX2_SQL}),
s AS (SELECT *, {_frame_url_sql('html', 'url')} AS frame_url FROM fp)
SELECT s.page_id, s.url, s.frame_url,
       CASE WHEN s.frame_url IS NULL THEN s.html ELSE coalesce(t.html, '') END AS html
FROM s LEFT JOIN (SELECT url, arg_max(html, page_id) AS html FROM fp GROUP BY url) t ON t.url = s.frame_url"""


@register("frame_resolve", FRAME_SQL)
def q_frame_resolve(spark, sf):
    return P.frame_resolve(FX.fx2_framed_pages(spark, sf)).select("page_id", "url", "frame_url", "html")


# ============================================================ H: html -> text

@register("html_strip_blocks", f"SELECT page_id, {H.strip_blocks_sql('html')} AS html FROM pages")
def q_html_strip_blocks(spark, sf):
    return FX.table(spark, sf, "pages", spread_rows=True).select("page_id", HT.strip_blocks("html").alias("html"))


@register("html_to_text", f"SELECT page_id, {H.tags_to_breaks_sql('html')} AS text FROM pages")
def q_html_to_text(spark, sf):
    return FX.table(spark, sf, "pages", spread_rows=True).select("page_id", HT.html_to_text("html").alias("text"))


@register("text_normalise", f"SELECT doc_id, {normalise_lines_sql('text')} AS text FROM documents")
def q_text_normalise(spark, sf):
    return FX.table(spark, sf, "documents", spread_rows=True).select("doc_id", HT.text_normalise("text").alias("text"))


@register("page_text", f"SELECT page_id, {HT.page_text_sql('html')} AS text FROM pages")
def q_page_text(spark, sf):
    return FX.table(spark, sf, "pages", spread_rows=True).select("page_id", HT.page_text("html").alias("text"))


@register("main_content", f"SELECT page_id, {HT.main_content_sql('html', ARTICLE)} AS content FROM pages")
def q_main_content(spark, sf):
    return FX.table(spark, sf, "pages", spread_rows=True).select("page_id", HT.main_content("html", ARTICLE).alias("content"))


@register("line_dedup_consecutive", f"""
SELECT doc_id, {HT.line_dedup_consecutive_sql(normalise_lines_sql('text', split_double_space=False))} AS text
FROM documents""")
def q_line_dedup_consecutive(spark, sf):
    t = HT.text_normalise("text", split_double_space=False)
    return FX.table(spark, sf, "documents", spread_rows=True).select("doc_id", HT.line_dedup_consecutive(t).alias("text"))


@register("content_text", f"SELECT page_id, {HT.content_text_sql('html', ARTICLE)} AS text FROM pages")
def q_content_text(spark, sf):
    pages = FX.table(spark, sf, "pages", spread_rows=True).select("page_id", "html")
    return HT.with_content_text(pages, "html", "text", ARTICLE).select("page_id", "text")


# ============================================================ H: listings

CARDS_SQL = L.listing_cards_sql(FX.FX3_CARDS_SQL)
ITEMS_SQL = L.listing_items_sql(FX.FX3_ITEMS_SQL)
PLACE_SQL = f"SELECT * FROM ({CARDS_SQL}) c WHERE contains(lower(venue), '{L.DEFAULT_PLACE}')"
CARD_LINE_SQL = "'Event: ' || title || ' | Datum: ' || date || ' | Ort: ' || venue"
LINES_SQL = f"""SELECT 0 AS source_rank, 'listing' AS source_name, {CARD_LINE_SQL} AS line, min(page) AS page
FROM ({PLACE_SQL}) f GROUP BY line"""


@register("listing_cards", CARDS_SQL)
def q_listing_cards(spark, sf):
    return L.listing_cards(FX.fx3_card_pages(spark, sf))


@register("listing_filter_place", PLACE_SQL)
def q_listing_filter_place(spark, sf):
    return L.listing_filter_place(L.listing_cards(FX.fx3_card_pages(spark, sf)))


def _card_pages(spark, sf):
    return FX.fx3_card_pages(spark, sf).selectExpr(*LISTING_SOURCE, "page", "html")


@register("listing_lines", LINES_SQL)
def q_listing_lines(spark, sf):
    cards = L.listing_filter_place(L.listing_cards(_card_pages(spark, sf), keep=("source_rank", "source_name", "page")))
    return L.listing_lines(cards).select("source_rank", "source_name", "line", "page")


UNITS_SQL = f"""SELECT source_rank, source_name, page, string_agg(line, chr(10) ORDER BY line) AS text
FROM ({LINES_SQL}) l GROUP BY ALL"""


@register("listing_text", UNITS_SQL)
def q_listing_text(spark, sf):
    return G.listing_units(_card_pages(spark, sf))


@register("listing_items", ITEMS_SQL)
def q_listing_items(spark, sf):
    return L.listing_items(FX.fx3_item_pages(spark, sf))


BLOCKS_SQL = f"""
SELECT 0 AS source_rank, 'listing' AS source_name, pg.page,
  CASE WHEN b.blocks IS NULL THEN 'No events found on listing.'
       ELSE 'Source: listing' || chr(10) || chr(10) || b.blocks END AS text
FROM ({FX.FX3_ITEMS_SQL}) pg LEFT JOIN (
  SELECT page, string_agg('Event: ' || title || chr(10) || 'Date: ' || date || chr(10) || 'Time: ' || time
                          || chr(10) || 'Location: ' || location, chr(10) || chr(10) ORDER BY item_idx) AS blocks
  FROM ({ITEMS_SQL}) i GROUP BY page) b USING (page)"""


@register("listing_blocks", BLOCKS_SQL)
def q_listing_blocks(spark, sf):
    pages = FX.fx3_item_pages(spark, sf).selectExpr(*LISTING_SOURCE, "page", "html")
    items = L.listing_items(pages, keep=("source_rank", "source_name", "page"))
    return L.listing_blocks(pages, items)


@register("upcoming_only", f"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events WHERE ts >= TIMESTAMP '{FX.AS_OF} 00:00:00'""")
def q_upcoming_only(spark, sf):
    df = L.upcoming_only(FX.table(spark, sf, "events"), "ts", FX.AS_OF)
    return df.select("event_id", wall_clock_text("ts").alias("ts"))


# ============================================================ J: registry joins, gather

@register("enabled_sources", f"SELECT * FROM ({FX.FX1_SQL}) r WHERE coalesce(enabled, false)")
def q_enabled_sources(spark, sf):
    return R.enabled_sources(FX.fx1_registry(spark, sf))


@register("enabled_sources_override", f"""
SELECT * FROM ({FX.FX1_SQL}) r WHERE name IN ({FX.FX1_OVERRIDE_SQL})""")
def q_enabled_sources_override(spark, sf):
    reg = FX.fx1_registry(spark, sf)
    return R.enabled_sources(reg, FX.fx1_override_names(reg))


PROFILE_SQL = f"""
SELECT r.*, coalesce(p.profile, 'generic') AS profile
FROM ({FX.FX1_SQL}) r LEFT JOIN ({FX.FX6_SQL}) p USING (name)"""


@register("source_profile", PROFILE_SQL)
def q_source_profile(spark, sf):
    reg = FX.fx1_registry(spark, sf)
    return R.source_profile(reg, FX.fx6_profiles(reg))


def _card_text_sql(html: str) -> str:
    segs = f"string_split_regex(coalesce({html}, ''), '{H.start_tag_re_sql('div', L.CARD_CLASS)}')[2:]"
    t = L._field_sql("s", "h3", L.CARD_TITLE, L.CARD_DEFAULTS[0])
    d = L._field_sql("s", "span", L.CARD_DATE, L.CARD_DEFAULTS[1])
    v = L._field_sql("s", "span", L.CARD_VENUE, L.CARD_DEFAULTS[2])
    lines = (f"list_transform(list_filter({segs}, lambda s: contains(lower({v}), '{L.DEFAULT_PLACE}')), "
             f"lambda s: 'Event: ' || {t} || ' | Datum: ' || {d} || ' | Ort: ' || {v})")
    return f"array_to_string(list_sort(list_distinct({lines})), chr(10))"


def _items_text_sql(html: str, name: str) -> str:
    segs = f"string_split_regex(coalesce({html}, ''), '{H.start_tag_re_sql('div', L.ITEM_CLASS)}')[2:]"
    info_pat = H.element_inner_re_sql("span", L.ITEM_INFO)
    infos = f"list_transform(regexp_extract_all(s, '{info_pat}', 1), lambda x: {H.get_text_strip_sql('x', ' ')})"
    block = ("'Event: ' || " + L._field_sql("s", "h2", L.ITEM_HEADLINE, L.ITEM_DEFAULTS[0])
             + " || chr(10) || 'Date: ' || " + L._field_sql("s", "p", L.ITEM_DATE, L.ITEM_DEFAULTS[1], " ")
             + f" || chr(10) || 'Time: ' || coalesce({infos}[2], '{L.ITEM_DEFAULTS[3]}')"
             + f" || chr(10) || 'Location: ' || coalesce({infos}[1], '{L.ITEM_DEFAULTS[2]}')")
    blocks = f"list_transform({segs}, lambda s: {block})"
    return (f"CASE WHEN len({segs}) = 0 THEN 'No events found on ' || {name} || '.' "
            f"ELSE 'Source: ' || {name} || chr(10) || chr(10) || array_to_string({blocks}, chr(10) || chr(10)) END")


GATHER_SQL = f"""
WITH reg AS ({PROFILE_SQL}),
fp AS ({FX.FX2_SQL}),
src AS (SELECT rank AS source_rank, name AS source_name, profile, {HOST_SQL} AS host
        FROM reg WHERE coalesce(enabled, false)),
cur AS (SELECT {HOST_SQL} AS host, max(page_id) AS page_id, arg_max(url, page_id) AS url,
               arg_max(html, page_id) AS html
        FROM fp WHERE coalesce(html, '') <> '' GROUP BY 1),
j AS (SELECT s.*, c.page_id, c.url, c.html FROM src s JOIN cur c USING (host)),
fr AS (SELECT j.* EXCLUDE (html),
              CASE WHEN profile <> 'frame' OR {_frame_url_sql('j.html', 'j.url')} IS NULL THEN j.html
                   ELSE coalesce(t.html, '') END AS html
       FROM j LEFT JOIN (SELECT url, arg_max(html, page_id) AS html FROM fp GROUP BY url) t
         ON j.profile = 'frame' AND t.url = {_frame_url_sql('j.html', 'j.url')})
SELECT source_rank, source_name, profile, page_id,
  CASE profile WHEN 'cards' THEN {_card_text_sql('html')}
               WHEN 'items' THEN {_items_text_sql('html', 'source_name')}
               WHEN 'lines' THEN {HT.content_text_sql('html')}
               ELSE {HT.page_text_sql('html')} END AS text
FROM fr"""


def _gathered(spark, sf):
    reg = FX.fx1_registry(spark, sf)
    return G.site_texts(reg, FX.fx6_profiles(reg), FX.fx2_framed_pages(spark, sf))


@register("site_texts", GATHER_SQL)
def q_site_texts(spark, sf):
    return _gathered(spark, sf)


@register("gathered_text", f"SELECT *, CAST(length(text) AS INTEGER) AS n_chars FROM ({GATHER_SQL}) g "
                          f"WHERE coalesce(text, '') <> ''")
def q_gathered_text(spark, sf):
    return E.gathered_text(_gathered(spark, sf))


@register("text_sink", f"""
SELECT replace(source_name, ' ', '_') AS source_key, text FROM ({GATHER_SQL}) g WHERE coalesce(text, '') <> ''""")
def q_text_sink(spark, sf):
    path = scratch_path(spark, "text-sink")
    S.text_sink(E.gathered_text(_gathered(spark, sf)), path)
    back = S.read_text_sink(spark, path)
    return back.select("source_key", F.regexp_replace("text", "\n\\z", "").alias("text"))


PROV_REG = "concat('src', CAST(rank % 17 AS string))"


@register("provenance", with_cte(feed_cte(FX.FX4_SQL), f"""
SELECT k.event_id, k.source_name, coalesce(u.url, '') AS source_url
FROM kept k LEFT JOIN (SELECT {PROV_REG} AS source_name, arg_max(url, rank) AS url
                       FROM ({FX.FX1_SQL}) r GROUP BY 1) u USING (source_name)"""))
def q_provenance(spark, sf):
    reg = FX.fx1_registry(spark, sf).withColumn("name", F.expr(PROV_REG))
    kept = E.parse_events(FX.fx4_candidates(spark, sf), FX.AS_OF)
    return E.provenance(kept, reg).select("event_id", "source_name", "source_url")


# ============================================================ X: chunks / extraction

DOCS_CHUNK_SQL = C.chunk_lines_sql("SELECT doc_id, text FROM documents", "doc_id")


@register("site_envelope", f"""
SELECT source_rank, source_name, {C.site_envelope_sql('source_name', 'text')} AS text
FROM ({GATHER_SQL}) g WHERE coalesce(text, '') <> ''""")
def q_site_envelope(spark, sf):
    g = E.gathered_text(_gathered(spark, sf))
    return g.select("source_rank", "source_name", C.site_envelope("source_name", "text").alias("text"))


@register("chunk_lines", DOCS_CHUNK_SQL)
def q_chunk_lines(spark, sf):
    return C.chunk_lines(FX.table(spark, sf, "documents", spread_rows=True).select("doc_id", "text"), "text")


@register("chunk_preview", f"""
SELECT doc_id, chunk_idx, {C.chunk_preview_sql('chunk')} AS preview FROM ({DOCS_CHUNK_SQL}) c""")
def q_chunk_preview(spark, sf):
    ch = C.chunk_lines(FX.table(spark, sf, "documents", spread_rows=True).select("doc_id", "text"), "text")
    return ch.select("doc_id", "chunk_idx", C.chunk_preview("chunk").alias("preview"))


@register("extraction_requests", f"""
SELECT doc_id, chunk_idx, '{C.SYSTEM_TEMPLATE.format(today=FX.AS_OF, default_year=2026, default_time='20:00')
                           .replace("'", "''").replace(chr(10), "' || chr(10) || '")}' AS system,
       '{C.USER_PREFIX.replace(chr(10), "' || chr(10) || '")}' || chunk AS "user"
FROM ({DOCS_CHUNK_SQL}) c""")
def q_extraction_requests(spark, sf):
    ch = C.chunk_lines(FX.table(spark, sf, "documents", spread_rows=True).select("doc_id", "text"), "text")
    return C.extraction_requests(ch, FX.AS_OF, keep=("doc_id", "chunk_idx"))


LISTING_CHUNKS_SQL = f"""
SELECT 0 AS source_rank, 'listing' AS source_name, page * {G.CHUNK_STRIDE} + chunk_idx AS chunk_idx, chunk
FROM ({C.chunk_lines_sql(f"SELECT page, {C.site_envelope_sql('source_name', 'text')} AS text FROM ({UNITS_SQL}) u",
                         "page")}) c"""


@register("listing_chunks", LISTING_CHUNKS_SQL)
def q_listing_chunks(spark, sf):
    return as_long(G.units_to_chunks(G.listing_units(_card_pages(spark, sf))))


def as_long(df):
    """Chunk positions of the fixture's small page numbers fit a bigint, as the oracle shows them."""
    return df.withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))


def _chunk_lines_sql(chunks_sql: str) -> str:
    """Lines of chunks, each with the three that follow it in its chunk."""
    return f"""
SELECT source_rank, source_name, chunk_idx, pos, l[pos + 1] AS l0, l[pos + 2] AS l1, l[pos + 3] AS l2, l[pos + 4] AS l3
FROM (SELECT *, string_split(coalesce(chunk, ''), chr(10)) AS l FROM ({chunks_sql}) c0) c1,
     LATERAL (SELECT unnest(range(0, len(l))) AS pos) r"""


def _unit_lines_sql(units_sql: str, rank: str, name: str) -> str:
    """Lines of units ``(page, text)``, each with its chunk and the three that follow it in the unit."""
    lead = ", ".join(f"lead(line, {n}) OVER (PARTITION BY page ORDER BY line_no) AS l{n}" for n in (1, 2, 3))
    return f"""
SELECT {rank} AS source_rank, {name} AS source_name, page * {G.CHUNK_STRIDE} + chunk_idx AS chunk_idx, line_no AS pos,
       line AS l0, {lead}
FROM ({C.chunked_lines_sql(units_sql, 'page')}) u"""


def _extract_sql(chunks_sql: str) -> str:
    return _extract_lines_sql(_chunk_lines_sql(chunks_sql))


def _extract_lines_sql(lines_sql: str) -> str:
    card, head = X.CARD_LINE_RE, X.BLOCK_HEAD_RE
    title = f"CASE WHEN is_card THEN regexp_extract(l0, '{card}', 1) ELSE regexp_extract(l0, '{head}', 1) END"
    date_text = f"CASE WHEN is_card THEN regexp_extract(l0, '{card}', 2) ELSE substr(l1, 7) END"
    time_text = f"CASE WHEN is_card THEN regexp_extract(l0, '{card}', 2) ELSE substr(l2, 7) END"
    place = f"CASE WHEN is_card THEN regexp_extract(l0, '{card}', 3) ELSE substr(l3, 11) END"
    unknown = ", ".join(f"'{u}'" for u in X.UNKNOWN_PLACES)
    return f"""
SELECT source_rank, source_name, chunk_idx, event_idx, title, date_raw,
       coalesce(time_raw, '{X.DEFAULT_TIME}') AS time_raw,
       CASE WHEN location IN ({unknown}) OR coalesce(location, '') = '' THEN source_name ELSE location END AS location,
       category_raw, description
FROM (
  SELECT source_rank, source_name, chunk_idx,
         CAST(row_number() OVER (PARTITION BY source_rank, source_name, chunk_idx ORDER BY pos) - 1 AS BIGINT)
           AS event_idx, {title} AS title,
         {X.iso_date_sql(f'({date_text})')} AS date_raw, {X.hh_mm_sql(f'({time_text})')} AS time_raw,
         {place} AS location, {title} AS category_raw, '' AS description
  FROM (
    SELECT *, regexp_matches(l0, '{card}') AS is_card,
           NOT regexp_matches(l0, '{card}') AND starts_with(l1, 'Date: ') AND starts_with(l2, 'Time: ')
             AND starts_with(l3, 'Location: ') AS is_block
    FROM ({lines_sql}) x
    WHERE starts_with(l0, 'Event: ')) y
  WHERE is_card OR is_block) z"""


EXTRACT_SQL = _extract_sql(LISTING_CHUNKS_SQL)


def _listing_candidates(spark, sf):
    return as_long(G.listing_events(_card_pages(spark, sf)))


@register("extract_events", EXTRACT_SQL)
def q_extract_events(spark, sf):
    return _listing_candidates(spark, sf)


def _item_units_sql(name: str) -> str:
    return (f"SELECT page, {C.site_envelope_sql(chr(39) + name + chr(39), 'text')} AS text "
            f"FROM (SELECT page, {_items_text_sql('html', chr(39) + name + chr(39))} AS text FROM ({FX.FX3_ITEMS_SQL}) p) q WHERE text <> ''")


@register("item_block_events", _extract_lines_sql(_unit_lines_sql(_item_units_sql("listing"), "0", "'listing'")))
def q_item_block_events(spark, sf):
    """Item pages -> blocks -> chunks -> events: blocks cut by a chunk's end are read on."""
    pages = FX.fx3_item_pages(spark, sf).selectExpr(*LISTING_SOURCE, "page", "html")
    units = pages.select("source_rank", "source_name", "page", G.items_text("html", "source_name").alias("text"))
    return as_long(X.extract_native(G.units_to_chunks(units, halo=X.HALO)))


@register("date_grammar_events", FX.FX9_EVENTS_SQL)
def q_date_grammar_events(spark, sf):
    """Pages of written dates (month names, ranges, several dates a line) -> events."""
    units = FX.fx9_written_dates(spark, sf).selectExpr(*LISTING_SOURCE, "page", "html")
    units = units.select("source_rank", "source_name", "page", HT.page_text("html").alias("text"))
    return X.extract_native(G.units_to_chunks(units, halo=X.HALO)).select("title", "date_raw", "time_raw")


@register("event_defaults", f"""
SELECT event_id, coalesce(time_raw, '20:00') AS time_raw,
       CASE WHEN coalesce(location, '') = '' THEN source_name ELSE location END AS location FROM ({FX.FX4_SQL}) c""")
def q_event_defaults(spark, sf):
    return X.event_defaults(FX.fx4_candidates(spark, sf)).select("event_id", "time_raw", "location")


LISTING_FEED_CTE = feed_cte(f"SELECT CAST(NULL AS BIGINT) AS event_id, * FROM ({EXTRACT_SQL}) e")


@register("listing_calendar", with_cte(LISTING_FEED_CTE, "SELECT * FROM lines"))
def q_listing_calendar(spark, sf):
    kept = E.parse_events(_listing_candidates(spark, sf), FX.AS_OF)
    return FD.build_feed(kept, FX.DTSTAMP)


@register("events_union", with_cte(LISTING_FEED_CTE, """
SELECT source_name, chunk_idx, event_idx, title, date_raw FROM kept
UNION ALL
SELECT source_name, chunk_idx, event_idx, title, date_raw FROM (""" + with_cte(feed_cte(FX.FX4_SQL), "SELECT * FROM kept") + ") f"))
def q_events_union(spark, sf):
    a = E.parse_events(_listing_candidates(spark, sf), FX.AS_OF)
    b = E.parse_events(FX.fx4_candidates(spark, sf), FX.AS_OF)
    cols = ["source_name", "chunk_idx", "event_idx", "title", "date_raw"]
    return E.events_union(a.select(*cols), b.select(*cols))
