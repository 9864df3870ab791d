"""Calendar rendering against golden rows of the reference's recorded output."""

import os

from calforge.operators import feed as FD
from calforge.sources import sinks as S
from calforge.session import scratch_path

SCHEMA = ("source_rank bigint, chunk_idx bigint, event_idx bigint, title string, date_raw string, time_raw string, "
          "location string, category string, description string")

# Golden events copied from the recorded musik/party calendars (stamp 20260316T233822Z).
GOLDEN = [
    (0, 0, 0, "Zwergbeats", "2026-04-25", "14:00", "Etage Eins", "musik", "Ein Live-Show von Zwergbeats."),
    (0, 0, 1, "ХАНЗА I KHANZA LIVE PRIVILEG CLUB I BRAUNSCHWEIG", "2026-03-28", "23:00", "Privileg Club", "musik",
     "Ein Live-Show von ХАНЗА."),
    (0, 0, 2, "Ü60 PARTY – LEGENDEN UNTER SICH - Sa, 9.5. ab 20 Uhr - Westand Braunschweig", "2026-05-09", "20:00",
     "Westand Kultur- und Eventzentrum", "party", "Eine Ü60 Party."),
]
EXPECTED_MUSIK = """BEGIN:VCALENDAR
VERSION:2.0
PRODID:-//Braunschweig Events//Musik
CALSCALE:GREGORIAN
METHOD:PUBLISH
X-WR-CALNAME:Braunschweig Musik
X-WR-TIMEZONE:Europe/Berlin
X-WR-CALDESC:Kommende Musik Events
BEGIN:VEVENT
UID:d845cd77-727f-5418-9cca-0141ac713a98@bs-events.de
DTSTAMP:20260316T233822Z
DTSTART;TZID=Europe/Berlin:20260425T140000
SUMMARY:Zwergbeats
DESCRIPTION:Ein Live-Show von Zwergbeats.
LOCATION:Etage Eins
END:VEVENT
BEGIN:VEVENT
UID:9ba3efb4-3c65-5f8e-b802-4205527d4fe3@bs-events.de
DTSTAMP:20260316T233822Z
DTSTART;TZID=Europe/Berlin:20260328T230000
SUMMARY:ХАНЗА I KHANZA LIVE PRIVILEG CLUB I BRAUNSCHWEIG
DESCRIPTION:Ein Live-Show von ХАНЗА.
LOCATION:Privileg Club
END:VEVENT
END:VCALENDAR"""


def document(lines, category):
    ordered = sorted((r for r in lines.collect() if r.category == category),
                     key=lambda r: (r.part, r.source_rank, r.chunk_idx, r.event_idx, r.line_no))
    return "\n".join(r.line for r in ordered)


def test_golden_render(spark):
    ev = spark.createDataFrame(GOLDEN, SCHEMA)
    lines = FD.build_feed(ev, "20260316T233822Z")
    assert document(lines, "musik") == EXPECTED_MUSIK
    party = document(lines, "party").split("\n")
    assert party[9] == "UID:e97ab165-b58f-5a9f-b031-7449f59bcf10@bs-events.de"
    assert party[12] == "SUMMARY:Ü60 PARTY – LEGENDEN UNTER SICH - Sa\\, 9.5. ab 20 Uhr - Westand Braunschweig"
    assert {r.category for r in lines.collect()} == {"musik", "party"}


def test_segments_rebuild_document(spark):
    ev = spark.createDataFrame(GOLDEN, SCHEMA)
    lines = FD.build_feed(ev, "20260316T233822Z")
    segs = sorted((r for r in FD.ics_document(lines).collect() if r.category == "musik"),
                  key=lambda r: (r.part, r.source_rank, r.chunk_idx))
    assert "\n".join(s.text for s in segs) == EXPECTED_MUSIK


def test_defaults_and_unknown_category(spark):
    ev = spark.createDataFrame([(0, 0, 0, None, "2026-04-25", None, None, "Whatever", "line1\nline2;x")], SCHEMA)
    doc = document(FD.build_feed(ev, "20260101T000000Z"), "sonstiges").split("\n")
    assert "DTSTART;TZID=Europe/Berlin:20260425T000000" in doc
    assert "SUMMARY:Event" in doc and "LOCATION:" in doc and "DESCRIPTION:line1\\nline2\\;x" in doc


def ics_files(path):
    top = path.replace("file:", "")
    return {os.path.relpath(os.path.join(d, f), top): open(os.path.join(d, f), encoding="utf-8").read()
            for d, _, fs in os.walk(top) for f in fs if f.endswith(".ics")}


def test_single_file_sink(spark):
    path = scratch_path(spark, "ics-test")
    ev = spark.createDataFrame(GOLDEN, SCHEMA)
    S.ics_sink(FD.build_feed(ev, "20260316T233822Z"), path, single_file=True)
    files = {os.path.dirname(k): v for k, v in ics_files(path).items()}
    assert len(ics_files(path)) == len(files) and set(files) == {"category=musik", "category=party"}
    assert files["category=musik"] == EXPECTED_MUSIK + "\n"
    # a run with only party events leaves the musik calendar in place
    S.ics_sink(FD.build_feed(ev.where("category = 'party'"), "20260316T233822Z"), path, single_file=True)
    assert {os.path.dirname(k) for k in ics_files(path)} == set(files)


def test_monthly_calendars_are_whole_and_hold_every_event_once(spark):
    ev = spark.createDataFrame(GOLDEN, SCHEMA)
    whole = [r.line for r in FD.build_feed(ev, "20260316T233822Z").where("part = 1").collect()]
    for pieces in (1, 3):
        path = scratch_path(spark, "ics-months")
        S.ics_sink(FD.build_months(ev, "20260316T233822Z"), path, pieces=pieces)
        seen = []
        for name, text in ics_files(path).items():
            lines = text.split("\n")
            assert lines[0] == "BEGIN:VCALENDAR" and lines[-2:] == ["END:VCALENDAR", ""] and lines.count(lines[0]) == 1
            month = name.split("month=")[1][:6]
            assert all(x.split(":")[1].startswith(month) for x in lines if x.startswith("DTSTART"))
            seen += lines[8:-2]
        assert sorted(seen) == sorted(whole)
        assert sorted(S.read_ics_sink(spark, path).columns) == ["category", "file_name", "line", "month", "piece"]


def test_a_hot_month_is_cut_evenly_in_date_order(spark):
    """One month, a third of it at one start, next to a small one."""
    rows = [(0, 0, i, f"E{i}", "2030-01-15" if i % 3 == 0 else f"2030-01-{1 + i * 7 % 28:02d}",
             "20:00" if i % 3 == 0 else f"{i % 24:02d}:{i % 60:02d}", "Ort", "party", "") for i in range(2000)]
    rows += [(0, 1, i, f"F{i}", "2030-02-01", "20:00", "Ort", "party", "") for i in range(30)]
    path = scratch_path(spark, "ics-hot")
    S.ics_sink(FD.build_months(spark.createDataFrame(rows, SCHEMA), "20260316T233822Z"), path, events=100)
    calendars = {}
    for name, text in ics_files(path).items():
        lines = text.split("\n")
        assert lines[0] == "BEGIN:VCALENDAR" and lines[-2:] == ["END:VCALENDAR", ""] and lines.count(lines[0]) == 1
        calendars[name.split("month=")[1][:6], int(name.split("piece=")[1].split("/")[0])] = [x for x in lines if x.startswith("DTSTART")]
    january = [calendars[k] for k in sorted(calendars) if k[0] == "203001"]
    assert len(january) == 20 and len(calendars) == 21 and len(calendars["203002", 0]) == 30
    assert sum(map(len, january)) == 2000 and max(map(len, january)) <= 140 and min(map(len, january)) >= 60
    assert all(a == sorted(a) for a in calendars.values()) and all(a[-1] <= b[0] for a, b in zip(january, january[1:]))


def test_a_month_has_as_many_calendars_as_its_events_need(spark):
    """More than a thousand calendars in a month, places that repeat or are missing, events of equal size."""
    rows = [(0, None if i % 50 == 0 else i % 7, i % 11, f"E{i}", f"2030-01-{1 + i % 28:02d}", "20:00", "Ort", "party", "") for i in range(2203)]
    rows += [(0, 1, i, f"F{i}", "2030-02-01", f"{i % 24:02d}:00", "Ort", "party", "") for i in range(3)]
    cut = S.with_pieces(FD.build_months(spark.createDataFrame(rows, SCHEMA), "20260316T233822Z"), events=2).select("month", "piece", "start").distinct()
    sizes = S.with_pieces(FD.build_months(spark.createDataFrame(rows, SCHEMA), "20260316T233822Z"), events=2).groupBy("month", "piece").count().collect()
    months = {m: [r["count"] for r in sizes if r.month == m] for m in ("203001", "203002")}
    assert len(months["203001"]) == 1102 and sum(months["203001"]) == 2203 and set(months["203001"]) <= {1, 2}
    assert len(months["203002"]) == 2 and sum(months["203002"]) == 3
    starts = {}
    for r in cut.collect():
        starts.setdefault((r.month, r.piece), []).append(r.start)
    january = [starts[k] for k in sorted(starts) if k[0] == "203001"]
    assert all(max(a) <= min(b) for a, b in zip(january, january[1:]))


def test_blocks_of_events_at_one_place_stay_whole(spark):
    """Two events of one start and one place: their lines do not mix."""
    rows = [(0, 0, 0, t, "2030-01-15", "20:00", "Ort", "party", "") for t in ("A", "B", "C")]
    path = scratch_path(spark, "ics-ties")
    S.ics_sink(FD.build_months(spark.createDataFrame(rows, SCHEMA), "20260316T233822Z"), path)
    (text,) = ics_files(path).values()
    lines = text.split("\n")
    blocks = [lines[8 + 8 * i:16 + 8 * i] for i in range(3)]
    assert all(b[0] == "BEGIN:VEVENT" and b[7] == "END:VEVENT" for b in blocks) and len(lines) == 8 + 24 + 2
    assert sorted(b[4] for b in blocks) == ["SUMMARY:A", "SUMMARY:B", "SUMMARY:C"]


def test_wall_clock_never_shifted_by_session_zone(spark):
    """2026-03-29 02:30 does not exist in Berlin (DST gap); the calendar must still
    say 20260329T023000, whatever the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("Europe/Berlin", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            ev = spark.createDataFrame([(0, 0, 0, "Nacht", "2026-03-29", "02:30", "Ort", "party", "")], SCHEMA)
            lines = [r.line for r in FD.build_feed(ev, "20260101T000000Z").collect()]
            assert "DTSTART;TZID=Europe/Berlin:20260329T023000" in lines, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
