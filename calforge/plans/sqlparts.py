"""DuckDB SQL fragments for the oracle side of the query catalog.

The oracle restates each operator in SQL with windows/row_number where that is the
plain way to say it; it shares only the regex/constant text with the Spark side.
"""

from __future__ import annotations

from calforge.functions.classify import bucket_sql, category_rank_sql, classify_sql
from calforge.functions.dates import dtstart_text_sql, parse_date_sql, parse_start_sql
from calforge.functions.text import ics_escape_sql, ustrip_sql
from calforge.functions.uid import event_uid_sql
from calforge.plans.fixtures import AS_OF, DTSTAMP, FX4_SQL


def key_sql(title: str, date: str) -> str:
    return f"({ustrip_sql(f'lower(coalesce({title}, {chr(39)}{chr(39)}))')} || '-' || coalesce({date}, ''))"


AS_OF_SQL = f"DATE '{AS_OF}'"

# candidates with E1/E3/E5 columns
def prepared_cte(cand_sql: str, as_of: str = AS_OF) -> str:
    AS_OF_SQL = f"DATE '{as_of}'"
    return f"""
c AS ({cand_sql}),
p AS (
  SELECT *, {classify_sql('category_raw')} AS category,
         {parse_date_sql('date_raw')} AS event_date,
         {key_sql('title', 'date_raw')} AS event_key
  FROM c),
st AS (
  SELECT *,
    CASE WHEN event_date IS NULL THEN 'invalid_date'
         WHEN event_date < {AS_OF_SQL} THEN 'past'
         WHEN row_number() OVER (PARTITION BY source_rank, source_name, event_key,
                                 (event_date IS NOT NULL AND event_date >= {AS_OF_SQL})
                                 ORDER BY chunk_idx, event_idx) > 1 THEN 'duplicate'
    END AS reject_reason
  FROM p),
kept AS (SELECT * EXCLUDE (reject_reason) FROM st WHERE reject_reason IS NULL)"""


PREPARED_CTE = prepared_cte(FX4_SQL)

# F1-F3 on kept events, then the global first-wins with the start time
def feed_cte(cand_sql: str, as_of: str = AS_OF) -> str:
    return prepared_cte(cand_sql, as_of) + f""",
fp AS (
  SELECT event_id, source_rank, chunk_idx, event_idx,
         {bucket_sql('category')} AS category,
         {category_rank_sql(bucket_sql('category'))} AS cat_rank,
         {ics_escape_sql("coalesce(title, 'Event')")} AS title,
         coalesce(date_raw, '') AS date_raw,
         coalesce(time_raw, '00:00') AS time_raw,
         {ics_escape_sql("coalesce(description, '')", newlines=True)} AS description,
         {ics_escape_sql("coalesce(location, '')")} AS location
  FROM kept),
fk AS (SELECT *, CASE WHEN date_raw <> '' THEN {key_sql('title', 'date_raw')} END AS feed_key FROM fp),
win AS (
  SELECT * EXCLUDE (rn), {parse_start_sql('date_raw', 'time_raw')} AS start_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY feed_key
                                     ORDER BY cat_rank, source_rank, chunk_idx, event_idx) AS rn
        FROM fk WHERE feed_key IS NOT NULL) t
  WHERE rn = 1),
body AS (
  SELECT category, 1 AS part, CAST(source_rank AS BIGINT) AS source_rank, CAST(chunk_idx AS BIGINT) AS chunk_idx,
         CAST(event_idx AS BIGINT) AS event_idx, u.line_no, u.line
  FROM (SELECT *, {event_uid_sql('title', 'date_raw')} AS uid FROM win WHERE start_ts IS NOT NULL) w,
  LATERAL (SELECT CAST(unnest(range(0, 8)) AS INTEGER) AS line_no,
                  unnest(['BEGIN:VEVENT', 'UID:' || uid, 'DTSTAMP:{DTSTAMP}',
                          'DTSTART;TZID=Europe/Berlin:' || {dtstart_text_sql('start_ts')},
                          'SUMMARY:' || title, 'DESCRIPTION:' || description, 'LOCATION:' || location,
                          'END:VEVENT']) AS line) u),
cats AS (SELECT DISTINCT category FROM fp),
envelope AS (
  SELECT category, 0 AS part, CAST(0 AS BIGINT) AS source_rank, CAST(0 AS BIGINT) AS chunk_idx,
         CAST(0 AS BIGINT) AS event_idx, h.line_no, h.line
  FROM cats, LATERAL (SELECT CAST(unnest(range(0, 8)) AS INTEGER) AS line_no,
    unnest(['BEGIN:VCALENDAR', 'VERSION:2.0',
            'PRODID:-//Braunschweig Events//' || upper(substr(category, 1, 1)) || substr(category, 2),
            'CALSCALE:GREGORIAN', 'METHOD:PUBLISH',
            'X-WR-CALNAME:Braunschweig ' || upper(substr(category, 1, 1)) || substr(category, 2),
            'X-WR-TIMEZONE:Europe/Berlin',
            'X-WR-CALDESC:Kommende ' || upper(substr(category, 1, 1)) || substr(category, 2) || ' Events'])
    AS line) h
  UNION ALL
  SELECT category, 2, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 0, 'END:VCALENDAR' FROM cats),
lines AS (SELECT * FROM envelope UNION ALL SELECT * FROM body)"""


FEED_CTE = feed_cte(FX4_SQL)


def with_cte(cte: str, select: str) -> str:
    return f"WITH {cte.strip()}\n{select}"
