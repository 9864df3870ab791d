"""Date lines, chunk positions of any page id, and what a run reports."""

from pyspark.sql import functions as F

from calforge.operators import extract as X
from calforge.plans import calendar_run as RUN
from calforge.plans import gather as G


def test_date_lines(spark):
    text = "\n".join([
        "--- START SITE: Halle 2030-01-01 ---",
        "Fr, 05.01.2030 | Konzert A, 19:30 Uhr", "Lesung B - 2030-02-03", "7.3.", "Tanz C", "Samstag 08.04.2030",
        "09.04.2030 D", "Version 1.2.3.4 und 32.01.2030, 10.13.2030", "12:30 Uhr",
        "Event: X | Datum: 01.05.2030 20:15 | Ort: Halle", "Event: Y", "Date: 2030-06-01", "Time: 18:00", "Location: Ort",
        "31.12.2030", "--- END SITE: Halle ---"])
    df = spark.createDataFrame([(0, "Halle", 0, text), (0, "Halle", 1, "Date: 2030-01-01\nTime: 18:00"), (0, "Halle", 2, None),
                                (0, "Halle", 3, "")], "source_rank bigint, source_name string, chunk_idx bigint, chunk string")
    got = [(r.event_idx, r.title, r.date_raw, r.time_raw, r.location) for r in
           X.extract_native(df).orderBy("chunk_idx", "event_idx").collect()]
    assert got == [
        (0, "Konzert A", "2030-01-05", "19:30", "Halle"), (1, "Lesung B", "2030-02-03", "20:00", "Halle"),
        (2, "Tanz C", "2026-03-07", "20:00", "Halle"), (3, None, "2030-04-08", "20:00", "Halle"),
        (4, "D", "2030-04-09", "20:00", "Halle"), (5, "X", "2030-05-01", "20:15", "Halle"),
        (6, "Y", "2030-06-01", "18:00", "Ort"), (7, None, "2030-12-31", "20:00", "Halle")]


def test_chunk_positions_of_any_page_id(spark):
    ids = [-(1 << 63), -5, 0, 1 << 43, (1 << 63) - 2, (1 << 63) - 1]
    long = "\n".join(f"line {i} of a long page" for i in range(1000))
    units = spark.createDataFrame([(0, "s", i, long) for i in ids], "source_rank bigint, source_name string, page bigint, text string")
    rows = [r.chunk_idx for r in G.units_to_chunks(units).collect()]
    assert len(set(rows)) == len(rows) > 2 * len(ids) and None not in rows
    pages = [int(p) // G.CHUNK_STRIDE for p in sorted(rows)]
    assert sorted(set(pages)) == ids


def test_report_counts_sources_without_events(spark):
    cols = "source_rank bigint, source_name string, chunk_idx bigint, event_idx bigint, title string, date_raw string, " \
           "time_raw string, location string, category_raw string, description string"
    row = (0, "a", 0, 0, "T", "2030-01-01", "20:00", "x", "party", "")
    cand = spark.createDataFrame([row, (0, "a", 0, 1, *row[4:]), (0, "a", 0, 2, "U", "soon", *row[6:]),
                                  (0, "a", 0, 3, "V", "2020-01-01", *row[6:])], cols)
    texts = spark.createDataFrame([("a", 10), ("a", 5), ("b", 7)], "source_name string, n_chars int")
    got = {r.source_name: r.asDict() for r in RUN.run_report(texts, cand, "2026-01-01").collect()}
    assert got["a"] == dict(source_name="a", n_sources=1, n_pages=2, n_chars=15, n_candidates=4, invalid_date=1, past=1,
                            duplicate=1, n_events=1)
    assert got["b"]["n_candidates"] == got["b"]["n_events"] == 0 and got["b"]["n_pages"] == 1
    assert (got[None]["n_sources"], got[None]["n_pages"], got[None]["n_chars"], got[None]["n_events"]) == (2, 3, 22, 1)
    empty = RUN.run_report(texts.limit(0), cand.limit(0), "2026-01-01").where(F.col("source_name").isNotNull())
    assert empty.count() == 0


def test_every_enabled_source_has_a_cause(spark):
    cols = "source_rank bigint, source_name string, chunk_idx bigint, event_idx bigint, title string, date_raw string, " \
           "time_raw string, location string, category_raw string, description string"
    cand = spark.createDataFrame([(0, "ok", 0, 0, "T", "2030-01-01", "20:00", "x", "party", ""),
                                  (0, "old", 0, 0, "T", "2020-01-01", "20:00", "x", "party", "")], cols)
    texts = spark.createDataFrame([("ok", 10), ("old", 5), ("blank", 0), ("blank", 0), ("quiet", 7), ("down", 9), ("half", 9)],
                                  "source_name string, n_chars int")
    names = ("ok", "old", "blank", "quiet", "down", "half", "missing", "missing")
    sources = spark.createDataFrame([(n,) for n in names], "name string")
    calls = spark.createDataFrame([("ok", 0, "ok", None), ("old", 0, "ok", None), ("quiet", 0, "ok", None), ("down", 1, "timeout", "no answer within 1 s"),
                                   ("down", 0, "failed", "ConnectionError: gone"), ("half", 0, "ok", None), ("half", 1, "invalid", "not an answer of events")],
                                  "source_name string, chunk_idx bigint, status string, error string")
    got = {r.source_name: (r.status, r.n_pages, r.n_events, r.n_failed, r.error) for r in
           RUN.source_report(sources, texts, cand, "2026-01-01", calls).collect()}
    assert got == {"ok": ("ok", 1, 1, 0, None), "old": ("no upcoming events", 1, 0, 0, None), "blank": ("empty text", 0, 0, 0, None),
                   "quiet": ("no events", 1, 0, 0, None), "down": ("extraction failed", 1, 0, 2, "ConnectionError: gone"),
                   "half": ("no events", 1, 0, 1, "not an answer of events"), "missing": ("no page", 0, 0, 0, None)}
    plain = {r.source_name: r.status for r in RUN.source_report(sources, texts, cand, "2026-01-01").collect()}
    assert plain["down"] == plain["half"] == "no events" and plain["missing"] == "no page"


def test_partitions_of_page_text_are_small_unless_the_cluster_says(spark):
    from calforge.session import apply_defaults
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert spark.conf.get(key) == "16m"
    spark.conf.set(key, "32m")
    try:
        apply_defaults(spark)
        assert spark.conf.get(key) == "32m"
    finally:
        spark.conf.set(key, "16m")


def test_events_of_a_large_source_stay_where_they_are(spark):
    """Urls of a short registry go to the events; a longer one is joined and gives the same."""
    from calforge.operators import events as E
    reg = spark.createDataFrame([("a", "u1", 0), ("a", "u2", 1), ("b", "u3", 2), (None, "u4", 3)], "name string, url string, rank bigint")
    ev = spark.createDataFrame([("a", i) for i in range(50)] + [("c", 50), (None, 51)], "source_name string, n int")
    # without its size in the plan, as after an aggregate over files
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent, joined = E.provenance(ev, reg), E.provenance(ev, reg, most=2)
        assert "BroadcastHashJoin" in sent._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        want = sorted([("a", i, "u2") for i in range(50)] + [("c", 50, ""), ("", 51, "")])
        for df in (sent, joined):
            assert sorted((r.source_name or "", r.n, r.source_url) for r in df.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_text_work_keeps_all_its_partitions(spark):
    from calforge.session import evenly
    rows = evenly(spark.createDataFrame([(i, "x") for i in range(200)], "page int, text string"), "page")
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
