"""The date grammar on lines, and events across the ends of chunks."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from calforge.functions import date_lines as D
from calforge.operators import extract as X
from calforge.plans import fixtures as FX
from calforge.plans import gather as G
from tests.conftest import SF001

SCHEMA = "source_rank bigint, source_name string, chunk_idx bigint, chunk string"


def events(spark, lines):
    """(title, date, time) of the events of each line, every line a chunk of its own."""
    df = spark.createDataFrame([(0, "Halle", i, line) for i, line in enumerate(lines)], SCHEMA)
    out = [[] for _ in lines]
    for r in X.extract_native(df).orderBy("chunk_idx", "event_idx").collect():
        assert r.event_idx == len(out[r.chunk_idx])
        out[r.chunk_idx].append((r.title, r.date_raw, r.time_raw))
    return out


def span(title, first, last, time="20:00"):
    a, b = map(dt.date.fromisoformat, (first, last))
    return [(title, str(a + dt.timedelta(i)), time) for i in range((b - a).days + 1)]


CASES = {
    "3. Mai 2026 um 18 Uhr Konzert": [("Konzert", "2026-05-03", "18:00")],
    "Konzert am 03. Mär 2026, 19.30 Uhr": [("Konzert", "2026-03-03", "19:30")],
    "Konzert, So. 3. mai": [("Konzert", "2026-05-03", "20:00")],
    "Lesung 01/06/2026": [("Lesung", "2026-06-01", "20:00")],
    "Lesung 1.6.26, 8 Uhr": [("Lesung", "2026-06-01", "08:00")],
    "12 May 2027 Reading": [("Reading", "2027-05-12", "20:00")],
    "Festival 12.-14.06.2026": span("Festival", "2026-06-12", "2026-06-14"),
    "Festival vom 12. bis 14. Juni 2026 ab 16 Uhr": span("Festival", "2026-06-12", "2026-06-14", "16:00"),
    "Festival Fr 12.06. – So 14.06.2026": span("Festival", "2026-06-12", "2026-06-14"),
    "Markt 30. November bis 2. Dezember": span("Markt", "2026-11-30", "2026-12-02"),
    "Markt 30.12.-2.1.2027": span("Markt", "2026-12-30", "2027-01-02"),
    "Markt 30.12. - 2.1.": span("Markt", "2026-12-30", "2027-01-02"),
    "Markt 30.12.2027 - 2.1.": span("Markt", "2027-12-30", "2028-01-02"),
    "Schau 2026-05-30 bis 2026-06-01": span("Schau", "2026-05-30", "2026-06-01"),
    "Tanz 12./13.06.2026": [("Tanz", "2026-06-12", "20:00"), ("Tanz", "2026-06-13", "20:00")],
    "Tanz 1., 3. und 5. Juni": [("Tanz", f"2026-06-0{d}", "20:00") for d in (1, 3, 5)],
    "Tanz 5.6. 20.30 Uhr / 7.6. 18 Uhr": [("Tanz", "2026-06-05", "20:30"), ("Tanz", "2026-06-07", "18:00")],
    "19:00 Uhr: Probe am 5.6. & 7.6.": [("Probe", "2026-06-05", "19:00"), ("Probe", "2026-06-07", "19:00")],
    "Kurs 5.6.2026, 18-20 Uhr": [("Kurs", "2026-06-05", "18:00")],
    "Kurs 5.6.2026 18:15 - 20:00 Uhr": [("Kurs", "2026-06-05", "18:15")],
    "Kurs 05.06.2026 Raum 3 | 9:30": [("Kurs Raum 3", "2026-06-05", "09:30")],
    "Feier 31.06.2026": [("Feier", "2026-06-31", "20:00")],
    "Feier 29.-31.06.2026": [("Feier", "2026-06-29", "20:00"), ("Feier", "2026-06-31", "20:00")],
    "Ewig 01.01.2026 - 01.01.2028": [("Ewig", "2026-01-01", "20:00"), ("Ewig", "2028-01-01", "20:00")],
    "Ewig 05.05.2026 - 01.05.2026": [("Ewig", "2026-05-05", "20:00"), ("Ewig", "2026-05-01", "20:00")],
    "Ganzes Jahr 1.1.-31.12.2026": span("Ganzes Jahr", "2026-01-01", "2026-12-31"),
    "Version 1.2.3 oder 10.000 Gäste um 20 Uhr": [], "2. Liga, 3. Platz": [], "19.30 Uhr": [], "5. Maifest": [], "3 Maiers": [], "": [],
    "14.06.2026": [(None, "2026-06-14", "20:00")],
}


def test_lines_by_the_grammar(spark):
    got = events(spark, list(CASES))
    assert dict(zip(CASES, got, strict=True)) == CASES


MONTHS = ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.dates(dt.date(2020, 1, 1), dt.date(2032, 1, 1)), st.integers(1, 40), st.integers(0, 4)), min_size=1, max_size=25))
def test_written_ranges_are_read_back(spark, spans):
    lines, want = [], []
    for a, n, form in spans:
        b = a + dt.timedelta(n)
        same = (a.year, a.month) == (b.year, b.month)
        name = f"{a.day}. {MONTHS[a.month - 1]} {a.year} bis {b.day}. {MONTHS[b.month - 1]} {b.year}"
        dotted = f"{a:%d.%m.%Y}–{b:%d.%m.%Y}"
        short = f"{a.day}.-{b.day}.{b.month}.{b.year}" if same else f"{a.day}.{a.month}. - {b.day}.{b.month}.{b.year}"
        words = f"{a.day}. bis {b.day}. {MONTHS[b.month - 1]} {b.year}" if same else name
        lines.append(f"Schau {(name, dotted, short, words, f'{a} - {b}')[form]} Saal")
        want.append(span("Schau Saal", str(a), str(b)))
    assert events(spark, lines) == want


def test_a_bare_range_takes_the_next_line(spark):
    df = spark.createDataFrame([(0, "Halle", 0, "5.-6. Juni 2026, 18 Uhr\nFest im Park\nkeine Zeit")], SCHEMA)
    got = [(r.title, r.date_raw, r.time_raw) for r in X.extract_native(df).orderBy("event_idx").collect()]
    assert got == span("Fest im Park", "2026-06-05", "2026-06-06", "18:00")


@pytest.mark.parametrize("max_chars", [1, 30, 60, 100, 3500])
def test_no_block_is_lost_at_the_end_of_a_chunk(spark, max_chars):
    lines = []
    for i in range(40):
        lines += [f"Event: A{i}", f"Date: 2030-01-{i % 28 + 1:02d}", "Time: 18:00", f"Location: Ort {i}", ""]
        lines += [f"{i % 28 + 1}.2.2030", f"Titel {i}"] if i % 3 == 0 else []
    units = spark.createDataFrame([(0, "s", 7, "\n".join(lines))], "source_rank bigint, source_name string, page bigint, text string")
    whole = X.extract_native(G.units_to_chunks(units, max_chars=1 << 20))
    parts = X.extract_native(G.units_to_chunks(units, max_chars=max_chars, halo=X.HALO))
    cols = ("title", "date_raw", "time_raw", "location")
    order = ("chunk_idx", "event_idx")
    assert [tuple(r) for r in parts.orderBy(*order).select(*cols).collect()] == [tuple(r) for r in whole.orderBy(*order).select(*cols).collect()]
    assert parts.select(*order).distinct().count() == parts.count() == 54


def test_every_item_of_every_page_is_found(spark):
    pages = FX.fx3_item_pages(spark, SF001).selectExpr("0 AS source_rank", "'listing' AS source_name", "page", "html")
    units = pages.select("source_rank", "source_name", "page", G.items_text("html", "source_name").alias("text"))
    found = X.extract_native(G.units_to_chunks(units, halo=X.HALO))
    assert found.count() == FX.table(spark, SF001, "events").count()
    assert found.groupBy("chunk_idx").agg(F.max("event_idx").alias("last"), F.count(F.lit(1)).alias("n")).where("last <> n - 1").isEmpty()


def test_the_start_of_a_token_hides_none(spark):
    """The guard at a token's start finds the same tokens as the pattern without it."""
    lines = [*CASES, "vom 3.5. bis 5.5.", "Beginn: 20:00, Einlass 19 Uhr", "ca. 8 Uhr am Sa., 3.5.2026", "xam 3.5.2026", "ſo 3.5.", "MI 4.5. UM 9 UHR"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    bare = D.TOKEN_RE.replace(D._START, "", 1)
    assert bare != D.TOKEN_RE
    both = df.selectExpr(f"regexp_extract_all(line, {D.quoted(D.TOKEN_RE)}, 0) AS x", f"regexp_extract_all(line, {D.quoted(bare)}, 0) AS y").collect()
    assert all(r.x == r.y for r in both) and sum(len(r.x) for r in both) > len(CASES)


def test_text_work_is_dealt_evenly(spark):
    """Stored texts compress well: their units are dealt by key, not by the size of files."""
    from calforge.session import evenly
    text = "concat_ws('', transform(sequence(1, 16), i -> sha2(concat(id, '.', i), 256))) AS text"
    df = evenly(spark.range(3000).selectExpr("'s' AS source_name", "id AS page", text).coalesce(1), "source_name", "page")
    sizes = [r["count"] for r in df.withColumn("p", F.spark_partition_id()).where("text <> ''").groupBy("p").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 3000 / 2


def test_lines_with_marks_and_dates_of_one_point(spark):
    """A line that holds a mark is read as any other, and short dates are read as long ones are."""
    lines = ["\x01 3.5.2030 | A", "B \x02 04.05.2030, 19 Uhr", "Fr, 5.6. C", "2030-07-08 D 20:15", "9.8.30 E", "12.12.2030 F 13.12.2030 G"]
    df = spark.createDataFrame([(0, "Halle", i, line) for i, line in enumerate(lines)], "source_rank bigint, source_name string, chunk_idx bigint, chunk string")
    got = [(r.chunk_idx, r.title, r.date_raw, r.time_raw) for r in X.extract_native(df).orderBy("chunk_idx", "event_idx").collect()]
    assert got == [(0, "\x01 | A", "2030-05-03", "20:00"), (1, "B \x02", "2030-05-04", "19:00"), (2, "C", "2026-06-05", "20:00"),
                   (3, "D", "2030-07-08", "20:15"), (4, "E", "2030-08-09", "20:00"), (5, "F G", "2030-12-12", "20:00"), (5, "F G", "2030-12-13", "20:00")]
