"""Streaming equals batch; registry reader; the driver contract."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from calforge.plans import fixtures as FX
from calforge.plans import gather as G
from calforge.plans.plugins import LineFormatExtractor
from calforge.operators import extract as X
from calforge.session import scratch_path
from calforge.sources import registry as R
from calforge.streaming import stream as ST
from calforge.streaming.upsert import upsert_events, upsert_latest
from tests.conftest import SF001, rows


def test_stream_equals_batch(spark):
    landing = scratch_path(spark, "landing-test")
    FX.fx3_card_pages(spark, SF001).repartition(3, "page").write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    cols = ("chunk_idx", "event_idx", "title", "date_raw", "event_key")
    out = ST.run_available(ST.page_candidates(ST.read_landing(spark, landing, schema, max_files=1)).select(*cols),
                           spark, "stream-test")
    batch = ST.page_candidates(spark.read.parquet(landing)).select(*cols)
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_registry_reader(spark):
    d = tempfile.mkdtemp(prefix="calforge-reg-")
    cfg = {"sources": [{"name": "A", "url": "https://a/", "enabled": True}, {"name": "B", "url": "https://b/"},
                       {"name": "", "url": "https://c/", "enabled": True}, {"name": "A", "url": "https://a2/"}]}
    with open(os.path.join(d, "config.json"), "w") as f:
        json.dump(cfg, f)
    reg = R.read_registry(spark, d)
    assert rows(reg, "rank", "name") == [(0, "A"), (1, "B"), (2, ""), (3, "A")]
    assert rows(R.enabled_sources(reg), "rank") == [(0,), (2,)]
    assert rows(R.source_names(reg), "rank") == [(0,), (1,), (3,)]
    override = spark.createDataFrame([("B",)], "name string")
    assert rows(R.enabled_sources(reg, override), "rank") == [(1,)]
    assert R.enabled_sources(reg, override.limit(0)).count() == 0


def test_plugin_equals_native(spark):
    pages = FX.fx3_card_pages(spark, SF001).selectExpr("0 AS source_rank", "'listing' AS source_name", "page", "html")
    chunks = G.units_to_chunks(G.listing_units(pages))
    keys = ("source_rank", "source_name", "chunk_idx")
    native = X.extract_native(chunks)
    plugin = X.event_defaults(X.parse_event_json(X.extract_with(chunks, LineFormatExtractor(), keys), keys))
    assert rows(native) == rows(plugin.select(*native.columns))


def test_failing_plugin_empties_only_its_chunk(spark):
    df = spark.createDataFrame([(0, "s", 0, "ok"), (0, "s", 1, "boom")],
                               "source_rank bigint, source_name string, chunk_idx bigint, chunk string")

    def model(text):
        if text == "boom":
            raise RuntimeError("timeout")
        return json.dumps({"events": [{"title": "T", "date": "2026-01-01", "time": "20:00", "location": "L",
                                       "category": 5, "description": ""}]})

    keys = ("source_rank", "source_name", "chunk_idx")
    out = X.parse_event_json(X.extract_with(df, model, keys), keys).collect()
    assert [(r.chunk_idx, r.category_raw) for r in out] == [(0, None)]   # non-string category -> fallback


def test_upsert(spark):
    old = spark.createDataFrame([("u1", 1), ("u2", 1)], "uid string, run int")
    new = spark.createDataFrame([("u2", 2), ("u3", 2)], "uid string, run int")
    assert rows(upsert_events(old, new)) == [("u1", 1), ("u2", 2), ("u3", 2)]
    assert rows(upsert_latest(old.unionByName(new))) == [("u1", 1), ("u2", 2), ("u3", 2)]


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["category", "part", "source_rank", "chunk_idx", "event_idx", "line_no", "line"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_calendar_run_end_to_end(spark):
    from calforge.plans import calendar_run as RUN
    from calforge.operators import feed as FD
    pages = (FX.fx3_card_pages(spark, SF001)
             .selectExpr("page AS page_id", "concat('https://cards.example/list/', CAST(page AS string)) AS url", "html"))
    registry = spark.createDataFrame([(0, "cards.example", "https://cards.example/", True)],
                                     "rank bigint, name string, url string, enabled boolean")
    profiles = spark.createDataFrame([("cards.example", "cards")], "name string, profile string")
    cand = RUN.extract_candidates(spark, registry, profiles, pages, FX.AS_OF)
    assert cand.count() > 0
    out = scratch_path(spark, "calendars")
    counts = {r.category: r for r in RUN.build_calendars(spark, cand, out, FX.AS_OF, "20240110T000000Z").collect()}
    written = sum(r.written for r in counts.values())
    back = spark.read.text(out)
    assert back.where(F.col("value") == "BEGIN:VEVENT").count() == written > 0
    # approval keeps only the approved uid
    kept = RUN.E.parse_events(cand, FX.AS_OF)
    one = kept.select(FD.uid_of_raw().alias("uid")).limit(1)
    counts2 = RUN.build_calendars(spark, cand, scratch_path(spark, "cal2"), FX.AS_OF, "20240110T000000Z", one)
    assert sum(r.n_events for r in counts2.collect()) == 1


def test_run_takes_every_listed_page(spark):
    from calforge.plans import calendar_run as RUN
    url = "concat('https://cards.example/list/', CAST(page AS string))"
    cards = FX.fx3_card_pages(spark, SF001)
    pages = cards.selectExpr("page AS page_id", f"{url} AS url", "html")
    stale = cards.selectExpr("page - 1000000 AS page_id", f"{url} AS url", "'<p>old</p>' AS html")
    registry = spark.createDataFrame([(0, "cards.example", "https://cards.example/", True)],
                                     "rank bigint, name string, url string, enabled boolean")
    profiles = spark.createDataFrame([("cards.example", "cards")], "name string, profile string")
    listings = pages.selectExpr("'cards.example' AS source_name", "url")
    cand = RUN.extract_candidates(spark, registry, profiles, pages.unionByName(stale), FX.AS_OF,
                                  listings=listings.unionByName(listings))
    units = G.listing_units(cards.selectExpr("0L AS source_rank", "'cards.example' AS source_name", "page", "html"))
    lines = units.select("page", F.explode(F.split("text", "\n")).alias("line")).distinct().count()
    assert pages.count() > 1
    assert cand.count() == lines
    assert [r[0] for r in cand.select("source_url").distinct().collect()] == ["https://cards.example/"]


def test_registry_missing_or_broken(spark):
    assert R.read_registry(spark, "/nonexistent/calforge/config.json").count() == 0
    d = tempfile.mkdtemp(prefix="calforge-reg-bad-")
    with open(os.path.join(d, "config.json"), "w") as f:
        f.write('{"sources": [ {"name": "A", ')
    assert R.read_registry(spark, d).count() == 0


def test_first_wins_is_idempotent_and_partition_free(spark):
    from calforge.operators import events as E
    from calforge.operators import feed as FD
    cand = FX.fx4_candidates(spark, SF001)
    once = E.parse_events(cand, FX.AS_OF)
    cols = ["source_rank", "chunk_idx", "event_idx"]
    assert rows(E.parse_events(once, FX.AS_OF), *cols) == rows(once, *cols)
    a = rows(FD.build_feed(once, "20240110T000000Z"))
    b = rows(FD.build_feed(once.repartition(7, "title"), "20240110T000000Z"))
    assert a == b


def test_landing_pages_and_registry_lines(spark):
    from calforge.sources import pages as P
    d = tempfile.mkdtemp(prefix="calforge-landing-")
    for name, html in (("a.html", "<p>x</p>"), ("b.html", ""), ("c.html", "<p>y\nz</p>")):
        with open(os.path.join(d, name), "w") as f:
            f.write(html)
    got = {os.path.basename(r.url): r.html for r in P.page_scan_landing(spark, d).collect()}
    assert got == {"a.html": "<p>x</p>", "c.html": "<p>y\nz</p>"}      # whole files, empty skipped
    j = tempfile.mkdtemp(prefix="calforge-reglines-")
    with open(os.path.join(j, "sources.jsonl"), "w") as f:
        for order, name in ((30, "c"), (10, "a"), (20, "b")):
            f.write(json.dumps({"rank": order, "name": name, "url": f"https://{name}/", "enabled": True}) + "\n")
    assert rows(R.read_registry_lines(spark, j), "rank", "name") == [(0, "a"), (1, "b"), (2, "c")]


class _BatchModel:
    """Answers a whole batch in one call; the batch fails when any chunk says 'boom'."""

    def __init__(self):
        self.inner = LineFormatExtractor()

    def __call__(self, text):
        if text == "boom":
            raise RuntimeError("bad chunk")
        return self.inner(text)

    def extract_batch(self, texts):
        if "boom" in texts:
            raise RuntimeError("batch failed")
        return [self.inner(t) for t in texts]


def test_batch_extractor_and_fallback(spark):
    keys = ("source_rank", "source_name", "chunk_idx")
    line = "Event: A | Datum: 12.05.2026 20:00 | Ort: Halle Braunschweig"
    df = spark.createDataFrame([(0, "s", 0, line), (0, "s", 1, "boom"), (0, "s", 2, line)],
                               "source_rank bigint, source_name string, chunk_idx bigint, chunk string").coalesce(1)
    out = X.parse_event_json(X.extract_with(df, _BatchModel(), keys), keys)
    assert sorted((r.chunk_idx, r.date_raw) for r in out.collect()) == [(0, "2026-05-12"), (2, "2026-05-12")]


def test_answer_parsing_rules(spark):
    ok = {"title": "T", "date": "2026-01-01", "time": "20:00", "location": "L", "category": "musik",
          "description": "", "extra": 1}
    answers = [
        (0, json.dumps({"events": [ok, dict(ok, category=None)]})),          # null category: kept, fallback
        (1, json.dumps({"events": [ok, {k: v for k, v in ok.items() if k != "category"}]})),  # missing key
        (2, json.dumps({"events": [ok, dict(ok, title=None)]})),             # null title
        (3, json.dumps({"events": {"title": "T"}})),                          # not an array
        (4, json.dumps({"events": []})),                                      # empty list
        (5, None),                                                            # failed call
    ]
    df = spark.createDataFrame([(0, "s", i, a) for i, a in answers],
                               "source_rank bigint, source_name string, chunk_idx bigint, response string")
    keys = ("source_rank", "source_name", "chunk_idx")
    got = sorted((r.chunk_idx, r.event_idx, r.category_raw) for r in X.parse_event_json(df, keys).collect())
    assert got == [(0, 0, "musik"), (0, 1, None)]


def test_micro_batches_do_not_grow_with_the_landing(spark, tmp_path, monkeypatch):
    """45,000 events land as 12 files of candidates, as 9 of pages: 8 micro-batches at most, all rows."""
    from calforge.plans import catalog_more as CM
    (spark.range(45000).selectExpr("id AS event_id", "timestamp_micros(1704067200000000 + id * 1000000) AS ts",
                                   "id % 100 AS user_id", "'view' AS event_type")
     .write.parquet(str(tmp_path / "events.parquet")))
    made = iter(str(tmp_path / f"s{i}") for i in range(99))
    monkeypatch.setattr(CM, "scratch_path", lambda *_: next(made))
    monkeypatch.setattr(ST, "scratch_path", lambda *_: next(made))
    keys = CM.q_stream_dedup(spark, str(tmp_path))
    assert rows(keys) == rows(ST.E.with_event_key(FX.fx4_candidates(spark, str(tmp_path))).select("source_name", "event_key").distinct())
    cols = ("chunk_idx", "event_idx", "event_key")
    want = rows(ST.page_candidates(FX.fx3_card_pages(spark, str(tmp_path))), *cols)
    assert rows(CM.q_stream_pages_to_events(spark, str(tmp_path)), *cols) == want
    assert rows(CM.q_stream_event_feed(spark, str(tmp_path)), *cols) == want
    batches = [len([f for f in p.iterdir() if f.name.isdigit()]) for p in tmp_path.glob("s*/_checkpoint/offsets")]
    assert len(batches) == 3 and all(1 < n <= ST.BATCHES for n in batches)
