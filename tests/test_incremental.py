"""Incremental runs give what full runs give, and extract only what changed."""

from calforge.plans import calendar_run as RUN
from calforge.plans import incremental as INC
from tests.conftest import rows

SOURCES = [("a.de", "generic"), ("b.de", "lines"), ("f.de", "frame")]


def world(spark, pages):
    registry = spark.createDataFrame([(i, n, f"https://{n}/", True) for i, (n, _) in enumerate(SOURCES)],
                                     "rank bigint, name string, url string, enabled boolean")
    profiles = spark.createDataFrame(SOURCES, "name string, profile string")
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    listings = spark.createDataFrame([(n, f"https://{n}/{i}") for n, _ in SOURCES for i in range(3)], "source_name string, url string")
    return registry, profiles, table, listings


def page(i, url, *titles):
    return i, url, "<html><nav>1.1.2030 x</nav><main>" + "".join(f"<p>{d}.6.2030 {t}</p>" for d, t in enumerate(titles, 1)) + "</main></html>"


class Counting:
    """An extractor by the line formats that counts its calls in a folder."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, chunk):
        import json
        import uuid
        from pathlib import Path
        Path(self.folder, uuid.uuid4().hex).write_text(chunk)
        events = [{"title": line.split(" ", 1)[1], "date": "2030-06-01", "time": "20:00", "location": "x", "category": "", "description": ""}
                  for line in chunk.split("\n") if line[:1].isdigit()]
        return json.dumps({"events": events})


def test_incremental_runs_equal_full_runs(spark, tmp_path):
    state = str(tmp_path / "state")
    frame = (30, "https://f.de/0", '<iframe src="https://b.de/1"></iframe>')
    first = [page(1, "https://a.de/0", "A", "B"), page(2, "https://a.de/1", "C"), page(3, "https://b.de/0", "D"), page(4, "https://b.de/1", "E"), frame]
    same = (11, "https://a.de/0", first[0][2].replace("<nav>1.1.2030 x</nav>", "<nav>other noise</nav>").replace("<p>", "<p class='new'>"))
    steps = [(first, 5), ([*first, same, page(12, "https://a.de/2", "F")], 1),
             ([*first, same, page(14, "https://b.de/1", "E", "G")], 2),      # the frame shows the new copy too
             (first[1:], 2)]                                                # older copies again: a change back
    cols = ("source_name", "chunk_idx", "event_idx", "title", "date_raw", "time_raw", "location", "source_url")
    for pages, n_changed in steps:
        registry, profiles, table, listings = world(spark, pages)
        cand, counts = INC.run(spark, registry, profiles, table, state, listings=listings)
        full = RUN.extract_candidates(spark, registry, profiles, table, "2026-01-01", listings=listings)
        assert rows(cand, *cols) == rows(full, *cols)
        assert counts["n_changed"] == n_changed, (counts, n_changed)


def test_a_second_run_calls_no_extractor(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    pages = [page(1, "https://a.de/0", "A"), page(2, "https://b.de/0", "B")]
    registry, profiles, table, listings = world(spark, pages)
    one, counts = INC.run(spark, registry, profiles, table, str(tmp_path / "s"), Counting(notes), listings)
    assert counts == {"n_texts": 2, "n_changed": 2, "n_extracted": 2} and len(list(notes.iterdir())) == 2
    want = rows(one, "source_name", "chunk_idx", "title")
    two, counts = INC.run(spark, registry, profiles, table, str(tmp_path / "s"), Counting(notes), listings)
    assert counts == {"n_texts": 2, "n_changed": 0, "n_extracted": 0} and len(list(notes.iterdir())) == 2
    assert rows(two, "source_name", "chunk_idx", "title") == want


def test_a_run_without_pages(spark, tmp_path):
    registry, profiles, table, listings = world(spark, [(1, "https://x.de/", "")])
    cand, counts = INC.run(spark, registry, profiles, table, str(tmp_path / "s"), listings=listings)
    assert cand.isEmpty() and counts == {"n_texts": 0, "n_changed": 0, "n_extracted": 0}
