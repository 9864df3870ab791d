"""Call control: timeouts, retries, outcomes, and answers that are not asked for twice."""

import json
import time
from pathlib import Path

from calforge.operators import calls as C
from calforge.operators import extract as X

CHUNKS = "source_rank bigint, source_name string, chunk_idx bigint, chunk string"
GOOD = json.dumps({"events": [{"title": "T", "date": "2030-01-01", "time": "20:00", "location": "L", "category": "musik", "description": ""}]})


class Scripted:
    """Does what the chunk's first word says; notes every call in a folder."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, chunk):
        notes = Path(self.folder, chunk.replace(" ", "_") or "empty")
        n = len(notes.read_text()) if notes.exists() else 0
        notes.write_text("x" * (n + 1))
        word = (chunk.split() or ["good"])[0]
        if word == "hang":
            time.sleep(60)
        if word == "raise" or (word == "once" and n == 0):
            raise ConnectionError("gone")
        return {"broken": "{", "list": "[]", "number": '{"events":[{"title":1}]}', "none": None}.get(word, GOOD)

    def calls(self):
        return {p.name: len(p.read_text()) for p in Path(self.folder).iterdir()}


def frame(spark, *texts):
    return spark.createDataFrame([(0, "s", i, t) for i, t in enumerate(texts)], CHUNKS)


def outcome(df):
    return {r.chunk_idx: (r.status, r.attempts, r.run) for r in df.collect()}


def test_outcomes_of_calls(spark, tmp_path):
    ask, notes = str(tmp_path / "store"), tmp_path / "notes"
    notes.mkdir()
    df = frame(spark, "good", "once", "raise", "broken", "list", "number", "none", "hang", "good", None)
    begin = time.time()
    out = C.call(df, Scripted(notes), ask, C.CallPolicy(timeout=1.0, calls_per_task=2))
    got = outcome(out)
    assert time.time() - begin < 40
    assert got == {0: ("ok", 1, 1), 1: ("ok", 2, 1), 2: ("failed", 2, 1), 3: ("invalid", 2, 1), 4: ("invalid", 2, 1), 5: ("invalid", 2, 1),
                   6: ("invalid", 2, 1), 7: ("timeout", 2, 1), 8: ("ok", 1, 1), 9: ("ok", 1, 1)}
    assert Scripted(notes).calls() == {"good": 1, "once": 2, "raise": 2, "broken": 2, "list": 2, "number": 2, "none": 2, "hang": 2, "empty": 1}
    assert X.parse_event_json(out.where("status = 'ok'")).count() == 4
    report = {r.source_name: r.asDict() for r in C.call_report(out).collect()}
    assert report["s"] == dict(source_name="s", n_chunks=10, ok=4, invalid=4, timeout=1, failed=1, retried=7) and report[None]["n_chunks"] == 10


def test_a_rerun_asks_only_for_what_has_no_good_answer(spark, tmp_path):
    ask, notes = str(tmp_path / "store"), tmp_path / "notes"
    notes.mkdir()
    C.call(frame(spark, "good a", "once b", "raise c"), Scripted(notes), ask)
    before = Scripted(notes).calls()
    got = outcome(C.call(frame(spark, "raise c", "good a", "once b", "good d", "good a"), Scripted(notes), ask))
    assert got == {0: ("failed", 2, 2), 1: ("ok", 1, 1), 2: ("ok", 2, 1), 3: ("ok", 1, 2), 4: ("ok", 1, 1)}
    after = Scripted(notes).calls()
    assert after == {**before, "raise_c": 4, "good_d": 1}
    third = C.call(frame(spark, "good a", "good d"), Scripted(notes), ask)
    assert outcome(third) == {0: ("ok", 1, 1), 1: ("ok", 1, 2)} and Scripted(notes).calls() == after
    assert C.call(spark.createDataFrame([], CHUNKS), Scripted(notes), ask).isEmpty()


class InBatches(Scripted):
    def extract_batch(self, texts):
        if any(t == "bad batch" for t in texts):
            raise ConnectionError("gone")
        return [GOOD if t.startswith("good") else "{" for t in texts]


def test_a_batch_call_is_the_first_attempt(spark, tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    got = outcome(C.call(frame(spark, "good", "second thoughts"), InBatches(notes), str(tmp_path / "a"), C.CallPolicy(calls_per_task=10)))
    assert got == {0: ("ok", 1, 1), 1: ("ok", 2, 1)} and Scripted(notes).calls() == {"second_thoughts": 1}
    got = outcome(C.call(frame(spark, "good", "bad batch"), InBatches(notes), str(tmp_path / "b"), C.CallPolicy(calls_per_task=10)))
    assert got == {0: ("ok", 1, 1), 1: ("ok", 1, 1)}


def test_chunks_are_made_once(spark, tmp_path):
    """What makes the chunks runs once, not for the count, the calls and the answers each."""
    notes, made = tmp_path / "notes", spark.sparkContext.accumulator(0)
    notes.mkdir()

    def count(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf

    got = outcome(C.call(frame(spark, "good a", "good b").mapInPandas(count, CHUNKS), Scripted(notes), str(tmp_path / "store")))
    assert got == {0: ("ok", 1, 1), 1: ("ok", 1, 1)} and made.value == 2
