"""Chunks -> candidate events.

Two interchangeable stages produce the same candidate-event columns:

* ``extract_native``: the default, with no model and no Python worker. It reads the
  rigid line formats the listing profiles write (card lines
  ``Event: t | Datum: d | Ort: v`` and 4-line item blocks) and, in any other text, the lines
  that hold a date, by the grammar of ``functions.date_lines``. Dates become ISO text.
* ``extract_with``: a plug-in ``Extractor`` (e.g. a model client) called per chunk
  from ``mapInPandas`` in Arrow batches; its JSON answers go through
  ``parse_event_json`` with the all-or-nothing rule: one invalid event or broken JSON
  empties the whole chunk, other chunks are unaffected. Catalyst does not push
  filters through ``mapInPandas``, so callers filter chunks *before* this stage, and
  should materialise its output (it is the expensive step).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calforge.functions import date_lines as D
from calforge.functions import html as H

# Defaults stated by the extraction rules.
DEFAULT_YEAR = 2026
DEFAULT_TIME = "20:00"
UNKNOWN_PLACES = ("Unbekannter Ort", "Unknown Location")

CARD_LINE_RE = r"\AEvent: (.*) \| Datum: (.*) \| Ort: (.*)\z"
BLOCK_HEAD_RE = r"\AEvent: (.*)\z"
BLOCK_LABELS = ("Event: ", "Date: ", "Time: ", "Location: ")
#: Lines that an event may reach beyond its first one.
HALO = len(BLOCK_LABELS) - 1

# Boundaries are spelled as (^|[^0-9]) / ($|[^0-9]) groups: RE2 has no lookaround.
DMY_RE = r"(^|[^0-9])([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})?"
ISO_RE = r"(^|[^0-9])([0-9]{4})-([0-9]{2})-([0-9]{2})($|[^0-9])"
HM_RE = r"(^|[^0-9])([0-9]{1,2}):([0-9]{2})($|[^0-9])"

_CUT = "\u0001"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def iso_date_expr(text: str, default_year: int = DEFAULT_YEAR) -> str:
    """First ISO or day.month[.year] date in a text, as YYYY-MM-DD; else the text (SQL text)."""
    year = f"IF(coalesce(get(dmy, 2), '') = '', '{default_year}', get(dmy, 2))"
    parts = f"split(regexp_replace(m, {H.quoted(r'\A[^0-9]')}, ''), {H.quoted(r'\.')})"
    dotted = H.bind(parts, "dmy", f"format_string('%s-%02d-%02d', {year}, try_cast(get(dmy, 1) AS int), try_cast(get(dmy, 0) AS int))")
    dmy = H.bind(f"regexp_extract(t, {H.quoted(DMY_RE)}, 0)", "m", f"IF(m <> '', {dotted}, t)")
    iso = H.bind(f"regexp_extract(t, {H.quoted(ISO_RE)}, 0)", "m", f"IF(m <> '', regexp_extract(m, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}', 0), {dmy})")
    begins = f"rlike(t, {H.quoted(r'\A[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])')})"
    return H.bind(text, "t", f"IF({begins}, substring(t, 1, 10), {iso})")


def iso_date_sql(expr: str, default_year: int = DEFAULT_YEAR) -> str:
    y = f"regexp_extract({expr}, '{DMY_RE}', 4)"
    dmy = (f"printf('%s-%02d-%02d', CASE WHEN {y} = '' THEN '{default_year}' ELSE {y} END, "
           f"TRY_CAST(regexp_extract({expr}, '{DMY_RE}', 3) AS INTEGER), "
           f"TRY_CAST(regexp_extract({expr}, '{DMY_RE}', 2) AS INTEGER))")
    iso = " || '-' || ".join(f"regexp_extract({expr}, '{ISO_RE}', {i})" for i in (2, 3, 4))
    return (f"CASE WHEN regexp_matches({expr}, '{ISO_RE}') THEN {iso} "
            f"WHEN regexp_matches({expr}, '{DMY_RE}') THEN {dmy} ELSE {expr} END")


def hh_mm_expr(text: str) -> str:
    """First H:MM in a text as HH:MM, else NULL (SQL text)."""
    found = f"regexp_extract(regexp_extract({text}, {H.quoted(HM_RE)}, 0), '[0-9]{{1,2}}:[0-9]{{2}}', 0)"
    return H.bind(found, "hm", "IF(hm <> '', lpad(hm, 5, '0'), CAST(NULL AS string))")


def hh_mm_sql(expr: str) -> str:
    return (f"CASE WHEN regexp_matches({expr}, '{HM_RE}') THEN printf('%02d:%s', "
            f"TRY_CAST(regexp_extract({expr}, '{HM_RE}', 2) AS INTEGER), regexp_extract({expr}, '{HM_RE}', 3)) END")


def event_defaults(df: DataFrame, default_time: str = DEFAULT_TIME) -> DataFrame:
    """Missing time -> default start; missing/unknown location -> the source."""
    loc = F.when(F.col("location").isin(*UNKNOWN_PLACES) | (F.coalesce(F.col("location"), F.lit("")) == ""),
                 F.col("source_name")).otherwise(F.col("location"))
    return (df.withColumn("time_raw", F.coalesce(F.col("time_raw"), F.lit(default_time)))
              .withColumn("location", loc))


def extract_native(chunks: DataFrame, default_year: int = DEFAULT_YEAR, default_time: str = DEFAULT_TIME,
                   keys=("source_rank", "source_name", "chunk_idx")) -> DataFrame:
    """X5 default stage: card lines, item blocks and other lines with a date -> candidate
    events, ``event_idx`` = position among the chunk's events (as in a model's answer).
    Every date of a line, and every day of a range, is an event of its own; what the line
    says besides is the title. A bare date takes the next line, unless that one has a date of
    its own or ends the site. A date without a year takes ``default_year``, an event of a date
    line happens at its source.

    Chunks with the columns ``before`` and ``after`` (the neighbouring lines, see
    ``chunk_lines(halo=)``) lose nothing at their ends: an event belongs to the chunk of its
    first line and may read on behind it. Every line is matched once against the date grammar."""
    halo = {"before", "after"} <= set(chunks.columns)
    none = F.array().cast("array<string>")
    with_lines = chunks.select(*keys, F.coalesce("before" if halo else none, none).alias("_before"),
                               F.split(F.coalesce(F.col("chunk"), F.lit("")), "\n").alias("_own"),
                               F.coalesce("after" if halo else none, none).alias("_after"))
    event, date, time, place = (H.quoted(x) for x in BLOCK_LABELS)
    cut = H.quoted(_CUT)

    def near(n):
        return f"get(ls, i + {n}).line" if n >= 0 else f"get(ls, i - {-n}).line"

    def after(line, name):
        return f"substring({line}, {len(name) + 1})"

    def rec(title, day, clock, location):
        return f"named_struct('title', {title}, 'date_raw', {day}, 'time_raw', {clock}, 'location', {location})"

    card = (f"IF(startswith(l.line, {event}), split(regexp_replace(l.line, {H.quoted(CARD_LINE_RE)}, "
            f"{H.quoted(f'$1{_CUT}$2{_CUT}$3')}), {cut}), CAST(NULL AS array<string>))")
    block = f"startswith(l.line, {event}) AND startswith({near(1)}, {date}) AND startswith({near(2)}, {time}) AND startswith({near(3)}, {place})"
    # lines of a block, also of one whose start is not here
    inner = " OR ".join(f"(startswith(l.line, {H.quoted(name)}) AND (i = 0 OR startswith({near(-1)}, {H.quoted(first)})))"
                        for name, first in zip(BLOCK_LABELS[1:], BLOCK_LABELS))
    dated = f"{D.has_date('l.toks')} AND NOT startswith(l.line, '--- ') AND NOT coalesce({inner}, false)"
    usable = f"NOT {D.has_date('get(ls, i + 1).toks')} AND NOT startswith({near(1)}, '--- ')"
    title = H.bind(D.without_dates("l.line", "l.marks"), "bare", f"CASE WHEN bare <> '' THEN bare WHEN {usable} THEN {near(1)} END")
    of_card = rec("get(c, 0)", f"{iso_date_expr('get(c, 1)', default_year)}", hh_mm_expr("get(c, 1)"), "get(c, 2)")
    of_block = rec(after("l.line", BLOCK_LABELS[0]), iso_date_expr(after(near(1), BLOCK_LABELS[1]), default_year),
                   hh_mm_expr(after(near(2), BLOCK_LABELS[2])), after(near(3), BLOCK_LABELS[3]))
    of_dates = H.bind(title, "title", f"transform({D.occasions('l.toks', default_year)}, o -> {rec('title', 'o.day', 'o.time', chr(39) * 2)})")
    none_here = "CAST(array() AS array<struct<title:string,date_raw:string,time_raw:string,location:string>>)"
    found = H.bind(card, "c", f"CASE WHEN size(c) = 3 THEN array({of_card}) WHEN {block} THEN array({of_block}) WHEN {dated} THEN {of_dates} ELSE {none_here} END")
    own = f"IF(i >= size(_before) AND i < size(_before) + size(_own), {found}, {none_here})"
    # a card line is known by its form alone: whatever date it has is in its own field
    toks = f"IF(startswith(line, {event}) AND rlike(line, {H.quoted(CARD_LINE_RE)}), array('card'), {D.tokens('line', 'marks')})"
    lines = (f"transform(concat(_before, _own, _after), line -> "
             f"{H.bind(D.marked('line'), 'marks', f'named_struct({chr(39)}line{chr(39)}, line, {chr(39)}marks{chr(39)}, marks, {chr(39)}toks{chr(39)}, {toks})')})")
    # all fields are computed inside the generator, so filters on them downstream
    # (validation) cannot be pushed below it and re-run the patterns
    ex = with_lines.select(*keys, F.posexplode(F.expr(H.bind(lines, "ls", f"flatten(transform(ls, (l, i) -> {own}))"))).alias("event_idx", "_e"))
    out = ex.select(
        *keys, F.col("event_idx").cast("bigint").alias("event_idx"), "_e.title", "_e.date_raw", "_e.time_raw",
        "_e.location", F.col("_e.title").alias("category_raw"), F.lit("").alias("description"))
    return event_defaults(out, default_time)


# -- plug-in stage -------------------------------------------------------------------

Extractor = Callable[[str], str]
"""chunk text -> JSON text ``{"events": [{title, date, time, location, category,
description}, ...]}``. Must be picklable; it runs on the executors."""


def extract_with(chunks: DataFrame, extractor: Extractor,
                 keys=("source_rank", "source_name", "chunk_idx")) -> DataFrame:
    """X5 plug-in stage: call ``extractor`` per chunk in Arrow batches; a failing call
    yields NULL (the chunk then has no events), other chunks go on. An extractor
    with ``extract_batch(list_of_chunks) -> list_of_answers`` gets one call per
    Arrow batch (``spark.sql.execution.arrow.maxRecordsPerBatch`` chunks); if that
    call fails, the batch falls back to one call per chunk."""
    schema = ", ".join([f"{k} {t}" for k, t in _key_types(chunks, keys)] + ["response string"])

    def one(text):
        try:
            return extractor(text)
        except Exception:  # noqa: BLE001 - a failed call empties this chunk only
            return None

    def run(batches: Iterator) -> Iterator:
        batch_call = getattr(extractor, "extract_batch", None)
        for pdf in batches:
            out = pdf[list(keys)].copy()
            texts = list(pdf["chunk"])
            answers = None
            if batch_call is not None:
                try:
                    answers = list(batch_call(texts))
                    if len(answers) != len(texts):
                        answers = None
                except Exception:  # noqa: BLE001
                    answers = None
            out["response"] = answers if answers is not None else [one(t) for t in texts]
            yield out

    return chunks.select(*keys, "chunk").mapInPandas(run, schema)


def _key_types(df: DataFrame, keys):
    types = dict(df.dtypes)
    return [(k, types[k]) for k in keys]


def parse_event_json(responses: DataFrame, keys=("source_rank", "source_name", "chunk_idx"),
                     response_col: str = "response") -> DataFrame:
    """``{"events":[...]}`` -> one row per event. The types are checked on the
    parsed variant (``from_json`` would silently turn 5 into '5'): title, date, time,
    location, description must be JSON strings; category must be present (a non-string
    becomes NULL, i.e. the fallback class). One bad event or broken JSON -> the whole
    chunk yields nothing."""
    parsed = responses.withColumn("_v", F.try_parse_json(F.col(response_col)))   # parse once per row
    v = F.col("_v")
    arr = F.try_variant_get(v, "$.events", "array<variant>")

    def valid(e):
        ok = None
        for f in ("title", "date", "time", "location", "description"):
            t = F.schema_of_variant(F.variant_get(e, f"$.{f}", "variant")) == "STRING"
            ok = t if ok is None else ok & t
        return ok & F.variant_get(e, "$.category", "variant").isNotNull()

    good = (F.schema_of_variant(F.variant_get(v, "$.events", "variant")).startswith("ARRAY")
            & F.forall(arr, lambda e: F.coalesce(valid(e), F.lit(False))))
    ev = parsed.select(*keys, F.when(good, arr).alias("_arr"))
    out = ev.select(*keys, F.posexplode("_arr").alias("event_idx", "_e"))

    def s(f):
        return F.try_variant_get(F.col("_e"), f"$.{f}", "string")

    cat_is_str = F.schema_of_variant(F.variant_get(F.col("_e"), "$.category", "variant")) == "STRING"
    return out.select(*keys, F.col("event_idx").cast("bigint").alias("event_idx"),
                      s("title").alias("title"), s("date").alias("date_raw"), s("time").alias("time_raw"),
                      s("location").alias("location"), F.when(cat_is_str, s("category")).alias("category_raw"),
                      s("description").alias("description"))
