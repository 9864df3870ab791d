"""Validation, first-wins dedup, rejects and the poison rule."""

from pyspark.sql import functions as F

from calforge.operators import events as E
from calforge.operators import feed as FD
from calforge.plans import fixtures as FX
from tests.conftest import SF01, rows

SCHEMA = ("source_rank bigint, source_name string, chunk_idx bigint, event_idx bigint, title string, "
          "date_raw string, time_raw string, location string, category_raw string, description string")


def cand(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_first_wins_within_source_and_reasons(spark):
    data = [
        (0, "a", 0, 0, "Konzert", "2026-05-01", "20:00", "x", "Konzert", ""),
        (0, "a", 0, 1, " KONZERT ", "2026-05-01", "21:00", "x", "Konzert", ""),   # duplicate (later)
        (0, "a", 1, 0, "Konzert", "2026-5-1", "20:00", "x", "Konzert", ""),       # other key: raw date differs
        (1, "b", 0, 0, "Konzert", "2026-05-01", "20:00", "x", "Konzert", ""),     # other source: kept
        (0, "a", 2, 0, "Alt", "2020-01-01", "20:00", "x", "Lesung", ""),          # past
        (0, "a", 2, 1, "Kaputt", "TBA", "20:00", "x", "Lesung", ""),              # invalid date
        (0, "a", 3, 0, "Heute", "2026-01-10", "20:00", "x", "Lesung", ""),        # today is kept
    ]
    st = E.event_status(cand(spark, data), "2026-01-10")
    got = rows(st, "source_rank", "chunk_idx", "event_idx", "reject_reason")
    assert got == sorted([(0, 0, 0, None), (0, 0, 1, "duplicate"), (0, 1, 0, None), (1, 0, 0, None),
                          (0, 2, 0, "past"), (0, 2, 1, "invalid_date"), (0, 3, 0, None)], key=str)
    kept = rows(E.parse_events(cand(spark, data), "2026-01-10"), "source_rank", "chunk_idx", "event_idx")
    assert kept == [(0, 0, 0), (0, 1, 0), (0, 3, 0), (1, 0, 0)]


def test_poison_rule_bad_time_claims_key(spark):
    # the party row (rank 0) has a bad time: it claims the key, so the valid musik
    # twin is dropped as a global duplicate and nothing is written for that key
    data = [
        (0, "a", 0, 0, "Show", "2026-05-01", "abends", "x", "Party", ""),
        (1, "b", 0, 0, "show", "2026-05-01", "20:00", "x", "Konzert", ""),
        (1, "b", 0, 1, "Andere", "2026-05-01", "20:00", "x", "Konzert", ""),
    ]
    kept = E.parse_events(cand(spark, data), "2026-01-10")
    lines = FD.build_feed(kept, "20260101T000000Z")
    summaries = [r.line for r in lines.where(F.col("line").startswith("SUMMARY:")).collect()]
    assert summaries == ["SUMMARY:Andere"]
    counts = {r.category: r for r in FD.feed_counts(kept).collect()}
    assert counts["party"].bad_time == 1 and counts["party"].written == 0
    assert counts["musik"].global_dup == 1 and counts["musik"].written == 1
    # header/footer exist for both buckets that received events
    assert {r.category for r in lines.where("part = 0").collect()} == {"party", "musik"}


def test_partitioning_does_not_change_results(spark):
    c = FX.fx4_candidates(spark, SF01)
    a = rows(E.parse_events(c, FX.AS_OF), "source_rank", "chunk_idx", "event_idx")
    b = rows(E.parse_events(c.repartition(13, "title"), FX.AS_OF), "source_rank", "chunk_idx", "event_idx")
    assert a == b


def test_fixture_funnel_counts(spark):
    """FX4 at sf0.01 with as_of 2024-01-10: the counts recorded in FIXTURES.md."""
    c = FX.fx4_candidates(spark, SF01)
    funnel = {r.category: (r.invalid_date, r.past, r.duplicate, r.kept) for r in E.funnel_counts(c, FX.AS_OF).collect()}
    assert funnel == {"party": (25, 737, 1041, 699), "kultur": (16, 491, 697, 462), "musik": (17, 491, 682, 476),
                      "theater": (17, 491, 717, 442), "sonstiges": (25, 737, 1050, 687)}
    feed = {r.category: (r.global_dup, r.bad_time, r.written)
            for r in FD.feed_counts(E.parse_events(c, FX.AS_OF)).collect()}
    assert feed == {"party": (61, 7, 631), "kultur": (128, 4, 330), "musik": (173, 3, 300),
                    "theater": (229, 4, 209), "sonstiges": (461, 3, 223)}


def test_rejects_count_equals_input_minus_kept(spark):
    c = FX.fx4_candidates(spark, SF01)
    assert E.event_rejects(c, FX.AS_OF).count() + E.parse_events(c, FX.AS_OF).count() == c.count()


def test_provenance_last_wins_and_miss(spark):
    reg = spark.createDataFrame([(0, "a", "u1"), (1, "b", "u2"), (2, "a", "u3")], "rank bigint, name string, url string")
    ev = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "source_name string, n int")
    assert rows(E.provenance(ev, reg), "source_name", "source_url") == [("a", "u3"), ("b", "u2"), ("c", "")]


def test_hot_key_third_of_rows(spark):
    """One (source, key) holds a third of all rows: first-wins stays exact, the
    per-key winner table is tiny, and with AQE's skew handling the join back that
    labels every row is split on the hot partition (forced small thresholds here)."""
    n = 6000
    base = spark.range(n).selectExpr(
        "0L AS source_rank", "'s' AS source_name", "id DIV 100 AS chunk_idx", "id % 100 AS event_idx",
        "CASE WHEN id % 3 = 0 THEN 'Hot Show' ELSE concat('Show ', CAST(id AS string)) END AS title",
        "'2026-05-01' AS date_raw", "'20:00' AS time_raw", "'x' AS location", "'Konzert' AS category_raw",
        "'' AS description")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        kept = E.parse_events(base, "2026-01-01")
        hot = kept.where("title = 'Hot Show'").collect()
        assert len(hot) == 1 and (hot[0].chunk_idx, hot[0].event_idx) == (0, 0)
        assert kept.count() == n - (n // 3) + 1
        status = E.event_status(base, "2026-01-01")
        counts = {r.reject_reason: r["count"] for r in status.groupBy("reject_reason").count().collect()}
        assert counts == {None: n - (n // 3) + 1, "duplicate": n // 3 - 1}
        status.collect()
        plan = status._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
