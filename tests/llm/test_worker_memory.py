"""What the text passes of the pipeline hold: arrays of a step, batches of a scan, and workers between their tasks."""

import tracemalloc

import numpy as np
import pyarrow as pa

from calforge.llm import common, minhash, words
from calforge.llm.common import bounded_batches, tidy, utf8

TEXTS = [" ".join(f"w{(i * i + n) % 5003}" for i in range(30_000)) for n in range(6)] + ["", None, "x" * 700_000, "a few words"]


def test_hashing_holds_little_beside_the_text(monkeypatch):
    """1.7 MB of text: below 20 MB of arrays at once, and the same sets however it is cut."""
    data, offs = utf8(pa.array(TEXTS, pa.string()))
    words.shingle_sets(data, offs)                # the tables of powers are made
    tracemalloc.start()
    sets, ends = words.shingle_sets(data[:1_000_000], np.array([0, 1_000_000]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20
    found = words.shingle_sets(data, offs)
    for size in (1 << 10, 1 << 22):
        monkeypatch.setattr(words, "STRETCH", size)
        assert all(np.array_equal(a, b) for a, b in zip(found, words.shingle_sets(data, offs), strict=True))


def test_a_pass_gives_memory_back_at_its_end(monkeypatch):
    freed = []
    monkeypatch.setattr(common, "_give_back", lambda: freed.append(1))
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(range(len(TEXTS))), pa.array(TEXTS, pa.string())], ["doc_id", "h", "text"])
    one, two = list(minhash._signatures([rows])), list(tidy(minhash._signatures)([rows]))
    assert one == two and freed == [1]


def test_scans_of_texts_read_few_rows_at_once(spark):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    other = spark.newSession()
    bounded_batches(other)
    assert int(other.conf.get(key)) == 512
    own = spark.newSession()
    own.conf.set(key, "100")
    bounded_batches(own)
    assert own.conf.get(key) == "100"
