"""Fixture views over the driver tables (see FIXTURES.md).

Each fixture exists twice: as a Spark DataFrame (``fx*``) and as DuckDB SQL text
(``FX*_SQL``) for the oracle. Where an expression is plain ANSI SQL it is written
once and used by both engines (``selectExpr`` on the Spark side), so both sides see
the same input rows. Every fixture reads whole driver tables; the modulo arithmetic
below only *varies* rows (which html a page gets, which flag a source has), it
never selects a subset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.operators.ordinal import dense_index
from calforge.session import scratch_path, shared_dir, spread

AS_OF = "2024-01-10"
DTSTAMP = "20240110T000000Z"


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A driver table. ``spread_rows`` marks heavy per-row text work right after the scan,
    which ``session.spread`` may spread (off unless the caller sets its number). Reads that
    go straight into an aggregate or join need no spreading (their shuffle does it)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


# ---------------------------------------------------------------- FX4 candidates

FX4_COLUMNS = (
    "event_id",
    "user_id % 20 AS source_rank",
    "concat('src', CAST(user_id % 20 AS string)) AS source_name",
    "CAST(floor(event_id / 500) AS bigint) AS chunk_idx",
    "event_id % 500 AS event_idx",
    """CASE event_id % 3
        WHEN 0 THEN upper(concat(event_type, ', Act ', CAST(user_id % 10 AS string), '; live'))
        WHEN 1 THEN concat(' ', event_type, ', Act ', CAST(user_id % 10 AS string), '; live')
        ELSE concat(event_type, ', Act ', CAST(user_id % 10 AS string), '; live') END AS title""",
    """CASE WHEN event_id % 101 = 0 THEN 'TBA'
        WHEN event_id % 7 = 0 THEN concat(CAST(year(ts) AS string), '-', CAST(month(ts) AS string), '-',
                                          CAST(day(ts) AS string))
        ELSE concat(CAST(year(ts) AS string), '-', lpad(CAST(month(ts) AS string), 2, '0'), '-',
                    lpad(CAST(day(ts) AS string), 2, '0')) END AS date_raw""",
    """CASE WHEN event_id % 97 = 0 THEN 'abends' WHEN event_id % 5 = 0 THEN CAST(NULL AS string)
        ELSE concat(lpad(CAST(hour(ts) AS string), 2, '0'), ':', lpad(CAST(minute(ts) AS string), 2, '0'))
        END AS time_raw""",
    """CASE event_id % 12 WHEN 0 THEN 'Clubnacht' WHEN 1 THEN ' PARTY ' WHEN 2 THEN 'Tanztheater'
        WHEN 3 THEN 'Musiktheater' WHEN 4 THEN 'Opera' WHEN 5 THEN 'Live-Konzert' WHEN 6 THEN 'Tribute Show'
        WHEN 7 THEN 'Lesung' WHEN 8 THEN 'Weihnachtsmarkt' WHEN 9 THEN 'Sport' WHEN 10 THEN ''
        ELSE CAST(NULL AS string) END AS category_raw""",
    "concat('Halle ', CAST(user_id % 7 AS string), ', Stadt') AS location",
    "CAST(NULL AS string) AS description",
)

FX4_SQL = "SELECT " + ",\n  ".join(FX4_COLUMNS) + "\nFROM events"


def fx4_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate events as an extraction stage would emit them (one row per event)."""
    return table(spark, sf_dir, "events", spread_rows=True).selectExpr(*FX4_COLUMNS)


# ---------------------------------------------------------------- FX1 registry

HOST_RE = r"\A[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)"
PATH_RE = r"\A[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)\z"


def fx1_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source per host of ``pages``: rank = dense order of the host's first
    page_id (from 0), url = url of that page, enabled = rank % 4 <> 0, left NULL when
    rank % 7 = 0 (tests the default). Hosts are aggregated map-side first."""
    pages = table(spark, sf_dir, "pages")
    hosts = (pages.select(F.regexp_extract("url", HOST_RE, 1).alias("name"), "page_id", "url")
             .groupBy("name")
             .agg(F.min("page_id").alias("first_page_id"), F.min_by("url", "page_id").alias("url")))
    ranked = dense_index(hosts, "first_page_id", "rank")
    registry = ranked.select(
        F.col("rank"), "name", "url",
        F.when(F.col("rank") % 7 == 0, F.lit(None).cast("boolean"))
         .otherwise(F.col("rank") % 4 != 0).alias("enabled"),
    )
    # A small dimension table used several times downstream (registry, profiles,
    # joins): computed once and cut from its lineage in the shared checkpoint folder,
    # so later plans read it instead of re-deriving it from the page table.
    shared_dir(spark)   # the session's spark.checkpoint.dir (set only where missing)
    return registry.checkpoint(eager=True)


FX1_SQL = f"""
SELECT rank, name, url, CASE WHEN rank % 7 = 0 THEN NULL ELSE rank % 4 <> 0 END AS enabled
FROM (
  SELECT row_number() OVER (ORDER BY first_page_id) - 1 AS rank, name, url
  FROM (SELECT regexp_extract(url, '{HOST_RE}', 1) AS name, min(page_id) AS first_page_id,
               arg_min(url, page_id) AS url
        FROM pages GROUP BY 1) h
) r"""


FIRST_LABEL_SQL = "split_part(name, '.', 1)"


def _first_label():
    return F.substring_index(F.col("name"), ".", 1)


def fx1_override_names(registry: DataFrame) -> DataFrame:
    """The manual source list used for J1: the blog hosts (a user picking sources)."""
    return registry.where(_first_label() == "blog").select("name")


FX1_OVERRIDE_SQL = f"SELECT name FROM ({FX1_SQL}) WHERE {FIRST_LABEL_SQL} = 'blog'"


# Source -> extraction profile table (J2). The reference maps fixed site names to
# site rules; the fixture world has host names, so the table lists hosts by their
# first label: www -> cards, m -> items, blog -> lines, a hyphenated label -> frame.
# Other hosts have no entry and fall back to the generic profile.
FX6_PROFILE_CASE = (f"CASE WHEN {FIRST_LABEL_SQL} = 'www' THEN 'cards' WHEN {FIRST_LABEL_SQL} = 'm' THEN 'items' "
                    f"WHEN {FIRST_LABEL_SQL} = 'blog' THEN 'lines' WHEN contains({FIRST_LABEL_SQL}, '-') THEN 'frame' END")


def fx6_profiles(registry: DataFrame) -> DataFrame:
    label = _first_label()
    profile = (F.when(label == "www", "cards").when(label == "m", "items").when(label == "blog", "lines")
                .when(label.contains("-"), "frame"))
    return registry.select("name", profile.alias("profile")).where(F.col("profile").isNotNull())


FX6_SQL = f"SELECT name, {FX6_PROFILE_CASE} AS profile FROM ({FX1_SQL}) r WHERE {FX6_PROFILE_CASE} IS NOT NULL"


# ---------------------------------------------------------------- FX2 framed pages

MISSING_FRAME_ROOT = "https://frames.example.invalid/"

FX2_SRC = f"""CASE WHEN p.page_id % 50 = 0 THEN concat('{MISSING_FRAME_ROOT}', CAST(p.page_id AS string))
     WHEN p.page_id % 20 = 0 THEN coalesce(n.url, '')
     WHEN p.page_id % 30 = 0 THEN substr(regexp_extract(p.url, '{PATH_RE}', 1), 2)
     ELSE regexp_extract(p.url, '{PATH_RE}', 1) END"""


def fx2_framed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth page becomes a frame wrapper whose src points (first case that
    holds) to a missing url, to the next page (absolute), to its own path without or
    with a leading '/'."""
    pages = table(spark, sf_dir, "pages")
    nxt = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    pid, path = F.col("page_id"), F.regexp_extract("url", PATH_RE, 1)
    src = (F.when(pid % 50 == 0, F.concat(F.lit(MISSING_FRAME_ROOT), pid.cast("string")))
            .when(pid % 20 == 0, F.coalesce("next_url", F.lit("")))
            .when(pid % 30 == 0, F.substring(path, 2, 1 << 30))
            .otherwise(path))
    wrapped = F.concat(F.lit('<html><body><iframe src="'), src, F.lit('"></iframe></body></html>'))
    return (pages.join(nxt, "page_id", "left")
            .select("page_id", "url",
                    F.when(F.col("page_id") % 10 == 0, wrapped).otherwise(F.col("html")).alias("html")))


FX2_SQL = f"""
SELECT p.page_id, p.url,
  CASE WHEN p.page_id % 10 = 0
       THEN concat('<html><body><iframe src="', {FX2_SRC}, '"></iframe></body></html>')
       ELSE p.html END AS html
FROM pages p LEFT JOIN pages n ON n.page_id = p.page_id + 1"""


# ---------------------------------------------------------------- FX3 listing pages

FX3_VENUE = ("CASE user_id % 3 WHEN 0 THEN 'Stadthalle Braunschweig' WHEN 1 THEN 'Hannover' END")
FX3_CARD = f"""concat('<div class="col event-card"><div class="in"><h3 class="event-card-title"> ',
  event_type, ' <b>', CAST(user_id % 50 AS string), '</b></h3><span class="event-card-date">',
  lpad(CAST(day(ts) AS string), 2, '0'), '.', lpad(CAST(month(ts) AS string), 2, '0'), '.',
  CAST(year(ts) AS string), ' ', lpad(CAST(hour(ts) AS string), 2, '0'), ':',
  lpad(CAST(minute(ts) AS string), 2, '0'), '</span>',
  CASE WHEN user_id % 3 = 2 THEN '' ELSE concat('<span class="event-card-venue">', {FX3_VENUE}, '</span>') END,
  '</div></div>')"""
FX3_ITEM = """concat('<div class="event-list__item"><h2 class="event-list__headline">',
  upper(event_type), ' &amp; Friends ', CAST(user_id % 40 AS string),
  '</h2><p class="event-list__date"><span>', CAST(year(ts) AS string), '-',
  lpad(CAST(month(ts) AS string), 2, '0'), '-', lpad(CAST(day(ts) AS string), 2, '0'),
  '</span> <em>ab</em></p>',
  CASE WHEN event_id % 4 >= 1 THEN concat('<span class="event-list__info-item"> Halle ',
    CAST(user_id % 7 AS string), ' </span>') ELSE '' END,
  CASE WHEN event_id % 4 >= 2 THEN concat('<span class="event-list__info-item">',
    lpad(CAST(hour(ts) AS string), 2, '0'), ':', lpad(CAST(minute(ts) AS string), 2, '0'), ' Uhr</span>')
    ELSE '' END,
  CASE WHEN event_id % 4 >= 3 THEN '<span class="event-list__info-item">Eintritt frei</span>' ELSE '' END,
  '</div>')"""

LISTING_PAGE_SIZE = 100


def _listing_pages(spark: SparkSession, sf_dir: str, element_sql: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    elems = ev.selectExpr(f"CAST(floor(event_id / {LISTING_PAGE_SIZE}) AS bigint) AS page",
                          "event_id", f"{element_sql} AS element")
    body = F.expr("listagg(element, '') WITHIN GROUP (ORDER BY event_id)")
    return (elems.groupBy("page").agg(body.alias("body"))
            .select("page", F.concat(F.lit("<html><body>"), F.col("body"), F.lit("</body></html>")).alias("html")))


def fx3_card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages with one event card per ``events`` row, 100 per page."""
    return _listing_pages(spark, sf_dir, FX3_CARD)


def fx3_item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages with one list item per ``events`` row (0-3 info spans)."""
    return _listing_pages(spark, sf_dir, FX3_ITEM)


def _listing_pages_sql(element_sql: str) -> str:
    return f"""
SELECT page, concat('<html><body>', string_agg(element, '' ORDER BY event_id), '</body></html>') AS html
FROM (SELECT CAST(floor(event_id / {LISTING_PAGE_SIZE}) AS bigint) AS page, event_id,
             {element_sql} AS element FROM events) e
GROUP BY page"""


FX3_CARDS_SQL = _listing_pages_sql(FX3_CARD)
FX3_ITEMS_SQL = _listing_pages_sql(FX3_ITEM)


# ---------------------------------------------------------------- FX5 model responses

BAD_EVENT_JSON = ('{"title":5,"date":"2030-01-01","time":"20:00","location":"Halle","category":"musik",'
                  '"description":""}')


def fx5_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4 grouped per (source, chunk) into ``{"events":[...]}`` text, as a model
    would answer; broken JSON when chunk_idx % 9 = 0, and an extra first event with a
    numeric title when chunk_idx % 9 = 4 (the whole chunk must then yield nothing).
    A group is one chunk's answer, so it is bounded by the chunk size."""
    c = fx4_candidates(spark, sf_dir)
    ev = F.struct(F.col("event_idx"), F.col("title"), F.col("date_raw").alias("date"),
                  F.coalesce("time_raw", F.lit("20:00")).alias("time"),
                  F.col("location"), F.col("category_raw").alias("category"),
                  F.coalesce("description", F.lit("")).alias("description"))
    grouped = (c.groupBy("source_rank", "source_name", "chunk_idx")
               .agg(F.array_sort(F.collect_list(ev)).alias("evs")))
    arr = F.to_json(F.transform("evs", lambda e: e.dropFields("event_idx")), {"ignoreNullFields": "false"})
    arr = F.when(F.col("chunk_idx") % 9 == 4,
                 F.concat(F.lit("[" + BAD_EVENT_JSON + ","), F.substring(arr, 2, 1 << 30))).otherwise(arr)
    js = F.concat(F.lit('{"events":'), arr, F.lit("}"))
    js = F.when(F.col("chunk_idx") % 9 == 0, F.concat(F.substring(js, 1, 40), F.lit("..."))).otherwise(js)
    return grouped.select("source_rank", "source_name", "chunk_idx", js.alias("response"))


# ---------------------------------------------------------------- FX7 pages with date lines

DATED_PAGE_SIZE = 50
_EVENT_DAY = "lpad(CAST(day(ts) AS string), 2, '0')"
_EVENT_MONTH = "lpad(CAST(month(ts) AS string), 2, '0')"
_EVENT_TIME = "concat(lpad(CAST(hour(ts) AS string), 2, '0'), ':', lpad(CAST(minute(ts) AS string), 2, '0'))"
FX7_ISO = f"concat(CAST(year(ts) AS string), '-', {_EVENT_MONTH}, '-', {_EVENT_DAY})"
FX7_TITLE = "concat(event_type, ' No. ', CAST(event_id AS string))"
FX7_ELEMENT = f"""CASE event_id % 3
  WHEN 0 THEN concat('<p title="5 > 4">', {_EVENT_DAY}, '.', {_EVENT_MONTH}, '.', CAST(year(ts) AS string), ', ',
                     {_EVENT_TIME}, ' Uhr | ', {FX7_TITLE}, '</p>')
  WHEN 1 THEN concat('<p>', {FX7_TITLE}, ' &ndash; ', {FX7_ISO}, '</p>')
  ELSE concat('<h3>Fr, ', CAST(day(ts) AS string), '.', CAST(month(ts) AS string), '.</h3><p>', {FX7_TITLE}, '</p>') END"""
# what a reader of those lines finds: the third form has no year and no time, the second no time
FX7_DATE = f"CASE WHEN event_id % 3 = 2 THEN concat('2026-', {_EVENT_MONTH}, '-', {_EVENT_DAY}) ELSE {FX7_ISO} END"
FX7_TIME = f"CASE WHEN event_id % 3 = 0 THEN {_EVENT_TIME} ELSE '20:00' END"


def fx7_dated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 50 events each as dated lines of ordinary text, inside ``<main>``."""
    elems = table(spark, sf_dir, "events").selectExpr(
        f"CAST(floor(event_id / {DATED_PAGE_SIZE}) AS bigint) AS page", "event_id", f"{FX7_ELEMENT} AS element")
    body = F.expr("listagg(element, '') WITHIN GROUP (ORDER BY event_id)")
    return (elems.groupBy("page").agg(body.alias("body"))
            .select("page", F.concat(F.lit("<html><body><main>"), F.col("body"), F.lit("</main></body></html>")).alias("html")))


# ---------------------------------------------------------------- FX9 pages of written dates

_MONTH_NAMES = ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")


def fx9_written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line for each ``events`` row as people write dates, 50 to a page: eight forms by
    ``event_id % 8``. The day is ts + user_id % 300 days; ranges end ``event_id % 5`` days later."""
    ev = table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{FX7_TITLE} AS title", "hour(ts) AS h", "minute(ts) AS mi", "date_add(CAST(ts AS date), CAST(user_id % 300 AS int)) AS a")
    ev = ev.withColumn("b", F.expr("date_add(a, CAST(event_id % 5 + 1 AS int))")).withColumn("c", F.expr("date_add(a, 7)"))
    names = "array(" + ", ".join(f"'{m}'" for m in _MONTH_NAMES) + ")"
    name = f"element_at({names}, month({{0}}))"
    line = F.expr(f"""CASE event_id % 8
      WHEN 0 THEN concat(day(a), '. ', {name.format('a')}, ' ', year(a), ' um ', h, ' Uhr | ', title)
      WHEN 1 THEN concat(title, ', ', date_format(a, 'dd/MM/yyyy'))
      WHEN 2 THEN concat(date_format(a, 'd.M.yyyy'), ' ', h, '.', lpad(mi, 2, '0'), ' Uhr ', title)
      WHEN 3 THEN concat(title, ' ', date_format(a, 'dd.MM.'), ' - ', date_format(b, 'dd.MM.yyyy'))
      WHEN 4 THEN concat(title, ' ', day(a), '.', IF(month(a) = month(b), '', concat(' ', {name.format('a')})), ' bis ', day(b), '. ',
                         {name.format('b')}, ' ', year(b))
      WHEN 5 THEN concat(date_format(a, 'd.M.'), ' 19 Uhr / ', date_format(c, 'd.M.'), ' 18:30 Uhr ', title)
      WHEN 6 THEN concat('Sa, ', day(a), '. ', substring({name.format('a')}, 1, 3), '</p><p>', title)
      ELSE concat(a, ' bis ', b, ': ', title) END""")
    body = F.expr("listagg(element, '') WITHIN GROUP (ORDER BY event_id)")
    elems = ev.select("event_id", F.floor(F.col("event_id") / DATED_PAGE_SIZE).cast("bigint").alias("page"),
                      F.concat(F.lit("<p>"), line, F.lit("</p>")).alias("element"))
    return (elems.groupBy("page").agg(body.alias("body"))
            .select("page", F.concat(F.lit("<html><body><nav>1.1.2030<p></nav>"), F.col("body"), F.lit("</body></html>")).alias("html")))


# what a reader finds there: no year in forms 5 and 6, no time in 1, 3, 4, 6 and 7
FX9_EVENTS_SQL = f"""
WITH ev AS (SELECT event_id, {FX7_TITLE} AS title, ts, CAST(ts AS DATE) + CAST(user_id % 300 AS INTEGER) AS a FROM events),
d AS (SELECT *, unnest(CASE WHEN event_id % 8 IN (3, 4, 7) THEN generate_series(0, CAST(event_id % 5 + 1 AS BIGINT))
                            WHEN event_id % 8 = 5 THEN [0, 7] ELSE [0] END) AS n FROM ev),
w AS (SELECT *, a + CAST(n AS INTEGER) AS day FROM d)
SELECT title, CASE WHEN event_id % 8 IN (5, 6) THEN '2026' || strftime(day, '-%m-%d') ELSE strftime(day, '%Y-%m-%d') END AS date_raw,
       CASE event_id % 8 WHEN 0 THEN strftime(ts, '%H') || ':00' WHEN 2 THEN strftime(ts, '%H:%M')
            WHEN 5 THEN CASE WHEN n = 0 THEN '19:00' ELSE '18:30' END ELSE '20:00' END AS time_raw
FROM w"""


# ---------------------------------------------------------------- FX8 a run over listed pages

RUN_SOURCES = (("cards.example", "cards"), ("items.example", "items"), ("text.example", "generic"),
               ("lines.example", "lines"), ("frames.example", "frame"))
RUN_RANK = 1_000_000


def fx8_run(spark: SparkSession, sf_dir: str):
    """``(registry, profiles, pages, listings)`` of one whole run: the hosts and framed pages of
    FX1 and FX2, and five sources read from all their listed pages: cards and items (FX3), and
    the dated pages (FX7) as plain text, as a content element and behind frames."""
    registry = fx1_registry(spark, sf_dir)
    extra = spark.createDataFrame([(RUN_RANK + i, n, f"https://{n}/", True) for i, (n, _) in enumerate(RUN_SOURCES)],
                                  registry.select("rank", "name", "url", "enabled").schema)
    profiles = fx6_profiles(registry).unionByName(spark.createDataFrame(list(RUN_SOURCES), "name string, profile string"))
    dated = fx7_dated_pages(spark, sf_dir)
    frame = dated.selectExpr(
        "page", "concat('<iframe data-src=\"x\" src=\\'https://text.example/', CAST(page AS string), '\\'></iframe>') AS html")
    made = None
    for i, ((name, _), rows) in enumerate(zip(RUN_SOURCES, (fx3_card_pages(spark, sf_dir), fx3_item_pages(spark, sf_dir),
                                                            dated, dated, frame))):
        one = rows.selectExpr(f"{RUN_RANK} * {i + 1}L * 1000000L + page AS page_id", f"'{name}' AS source_name",
                              f"concat('https://{name}/', CAST(page AS string)) AS url", "html")
        made = one if made is None else made.unionByName(one)
    # landed once as the run's page table, which gathering reads several times
    landed = scratch_path(spark, "run-pages")
    made.unionByName(fx2_framed_pages(spark, sf_dir), allowMissingColumns=True).write.parquet(landed)
    pages = spark.read.parquet(landed)
    listings = pages.where("source_name is not null").select("source_name", "url")
    return registry.unionByName(extra), profiles, pages.drop("source_name"), listings
