"""Site text -> bounded chunks for extraction.

The chunker is greedy over lines: a line costs len+1; a chunk is flushed when the
next line would push it over ``max_chars`` (and it is not empty); an over-long line
becomes its own over-size chunk; a text of at most ``max_chars`` is one chunk.
Greedy packing with reset is not a window function, so it runs as a fold over the
*line lengths* of each text (``aggregate``), which only yields the chunk start
lines; chunk text is then cut with ``slice``/``array_join``. No string is rebuilt
inside the fold. A text is one row, so the work spreads over rows with no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CHARS = 3500
PREVIEW_CHARS = 200


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def site_envelope(name, text) -> Column:
    """start/end markers around a site's text (applied before chunking)."""
    n = _c(name)
    return F.concat(F.lit("--- START SITE: "), n, F.lit(" ---\n"), _c(text), F.lit("\n--- END SITE: "), n,
                    F.lit(" ---"))


def site_envelope_sql(name: str, text: str) -> str:
    return (f"('--- START SITE: ' || {name} || ' ---' || chr(10) || {text} || chr(10) || "
            f"'--- END SITE: ' || {name} || ' ---')")


def _starts(lines: Column, max_chars: int) -> Column:
    """0-based first line of every chunk: a fold over the line costs only."""
    costs = F.transform(lines, lambda x: F.length(x) + 1)
    zero = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("size"), F.lit(0).alias("i"))

    def step(acc, cost):
        flush = (acc["size"] + cost > max_chars) & (acc["size"] > 0)
        return F.struct(
            F.when(flush, F.array_append(acc["starts"], acc["i"])).otherwise(acc["starts"]).alias("starts"),
            F.when(flush, cost).otherwise(acc["size"] + cost).alias("size"),
            (acc["i"] + 1).alias("i"),
        )

    return F.concat(F.array(F.lit(0)), F.aggregate(costs, zero, step)["starts"])


def chunk_lines(df: DataFrame, text_col: str = "text", keep=None, max_chars: int = MAX_CHARS, halo: int = 0) -> DataFrame:
    """One row per chunk: ``chunk_idx`` (0-based order) and ``chunk``. With ``halo`` also
    ``before`` and ``after``: up to so many lines of the text on either side of the chunk.

    Three projections so every array is computed once per row: the lines, the chunk
    starts (fold), then each chunk as ``slice`` of the lines between two starts."""
    keep = [c for c in (keep or df.columns) if c != text_col]
    t = F.coalesce(F.col(text_col), F.lit(""))
    step1 = df.select(*keep, t.alias("_t"), F.split(t, "\n").alias("_lines"))
    step2 = step1.select(*keep, "_t", "_lines", _starts(F.col("_lines"), max_chars).alias("_starts"))
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts") - 1, F.lit(0))), F.array(F.size("_lines")))
    if not halo:
        pieces = F.zip_with("_starts", ends, lambda s, e: F.array_join(F.slice(F.col("_lines"), s + 1, e - s), "\n"))
        chunks = F.when(F.length("_t") <= max_chars, F.array("_t")).otherwise(pieces)
        return step2.select(*keep, F.posexplode(chunks).alias("chunk_idx", "chunk"))

    def piece(s, e):
        first = F.greatest(s - halo, F.lit(0))
        return F.struct(F.array_join(F.slice(F.col("_lines"), s + 1, e - s), "\n").alias("chunk"),
                        F.slice(F.col("_lines"), first + 1, s - first).alias("before"),
                        F.slice(F.col("_lines"), e + 1, F.lit(halo)).alias("after"))

    none = F.array().cast("array<string>")
    whole = F.array(F.struct(F.col("_t").alias("chunk"), none.alias("before"), none.alias("after")))
    chunks = F.when(F.length("_t") <= max_chars, whole).otherwise(F.zip_with("_starts", ends, piece))
    return step2.select(*keep, F.posexplode(chunks).alias("chunk_idx", "_p")).select(*keep, "chunk_idx", "_p.*")


def chunk_lines_sql(source_sql: str, key: str, text: str = "text", max_chars: int = MAX_CHARS) -> str:
    """Oracle: recursive CTE over (key, line_no) carrying (size, chunk_idx)."""
    return f"""
WITH RECURSIVE src AS (SELECT {key} AS k, coalesce({text}, '') AS t FROM ({source_sql}) s0),
ln AS (SELECT k, generate_subscripts(parts, 1) AS line_no, unnest(parts) AS line
       FROM (SELECT k, string_split(t, chr(10)) AS parts FROM src WHERE length(t) > {max_chars}) s1),
r AS (
  SELECT k, line_no, length(line) + 1 AS size, 0 AS chunk_idx FROM ln WHERE line_no = 1
  UNION ALL
  SELECT ln.k, ln.line_no,
         CASE WHEN r.size + length(ln.line) + 1 > {max_chars} THEN length(ln.line) + 1
              ELSE r.size + length(ln.line) + 1 END,
         CASE WHEN r.size + length(ln.line) + 1 > {max_chars} THEN r.chunk_idx + 1 ELSE r.chunk_idx END
  FROM r JOIN ln ON ln.k = r.k AND ln.line_no = r.line_no + 1)
SELECT k AS {key}, chunk_idx, string_agg(line, chr(10) ORDER BY line_no) AS chunk
FROM r JOIN ln USING (k, line_no) GROUP BY k, chunk_idx
UNION ALL
SELECT k AS {key}, 0 AS chunk_idx, t AS chunk FROM src WHERE length(t) <= {max_chars}"""


def chunked_lines_sql(source_sql: str, key: str, text: str = "text", max_chars: int = MAX_CHARS) -> str:
    """Oracle: every line of every text with the chunk it falls into."""
    return f"""
WITH RECURSIVE src AS (SELECT {key} AS k, string_split(coalesce({text}, ''), chr(10)) AS parts,
                              length(coalesce({text}, '')) > {max_chars} AS long FROM ({source_sql}) s0),
ln AS (SELECT k, long, generate_subscripts(parts, 1) AS line_no, unnest(parts) AS line FROM src),
r AS (
  SELECT k, line_no, length(line) + 1 AS size, 0 AS chunk_idx FROM ln WHERE line_no = 1
  UNION ALL
  SELECT ln.k, ln.line_no,
         CASE WHEN long AND r.size + length(ln.line) + 1 > {max_chars} THEN length(ln.line) + 1 ELSE r.size + length(ln.line) + 1 END,
         CASE WHEN long AND r.size + length(ln.line) + 1 > {max_chars} THEN r.chunk_idx + 1 ELSE r.chunk_idx END
  FROM r JOIN ln ON ln.k = r.k AND ln.line_no = r.line_no + 1)
SELECT k AS {key}, line_no, line, chunk_idx FROM r JOIN ln USING (k, line_no)"""


def chunk_preview(chunk, n: int = PREVIEW_CHARS) -> Column:
    """First ``n`` characters with line breaks shown as blanks."""
    return F.replace(F.substring(_c(chunk), 1, n), F.lit("\n"), F.lit(" "))


def chunk_preview_sql(chunk: str, n: int = PREVIEW_CHARS) -> str:
    return f"replace(substr({chunk}, 1, {n}), chr(10), ' ')"


# Prompt text for the plug-in extraction stage. The wording is ours; the rules it
# states are the reference's (ISO dates, default year, default start time, five
# categories, location = venue, one event per date).
SYSTEM_TEMPLATE = (
    "You extract structured event data from German venue web pages. Today is {today}.\n"
    "Return every upcoming event (from today on) as JSON {{\"events\": [...]}} with the string fields "
    "title, date (YYYY-MM-DD), time (HH:MM), location, category, description.\n"
    "Rules: a date without year uses {default_year}; no time given -> \"{default_time}\"; skip past events; "
    "category is exactly one of party, musik, theater, kultur, sonstiges; location is the actual venue "
    "(usually the site itself); description is one short sentence; every date is its own event; "
    "no events -> an empty list."
)
USER_PREFIX = "Extract all events from this text:\n\n"


def extraction_requests(chunks: DataFrame, as_of, default_year: int = 2026, default_time: str = "20:00",
                        keep=("source_rank", "source_name", "chunk_idx")) -> DataFrame:
    """One request row per chunk (system text with the run date, user text)."""
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    system = SYSTEM_TEMPLATE.format(today=as_of, default_year=default_year, default_time=default_time)
    return chunks.select(*keep, F.lit(system).alias("system"),
                         F.concat(F.lit(USER_PREFIX), F.col("chunk")).alias("user"))
