"""Greedy line chunker: the properties that define it."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from calforge.operators.chunks import chunk_lines, chunk_preview, site_envelope
from tests.conftest import SF01


def check_chunks(text: str, chunks: list[str], limit: int) -> None:
    """What any greedy cut at line ends satisfies."""
    assert "\n".join(chunks) == text
    if len(text) <= limit:
        assert chunks == [text]
        return
    for i, chunk in enumerate(chunks):
        assert "\n" not in chunk or len(chunk) < limit          # only a single line may be too long
        if i + 1 < len(chunks):                                  # the next line did not fit any more
            assert len(chunk) + 1 + len(chunks[i + 1].partition("\n")[0]) + 1 > limit


LINES = st.lists(st.text(alphabet="ab ü😀", max_size=25), max_size=30).map("\n".join)


@settings(max_examples=30, deadline=None)
@given(st.lists(LINES, min_size=1, max_size=12), st.sampled_from([1, 5, 20, 40]))
def test_chunks_are_greedy(spark, texts, max_chars):
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    got = {}
    for r in chunk_lines(df, "text", max_chars=max_chars).collect():
        got.setdefault(r.doc, []).append((r.chunk_idx, r.chunk))
    for doc, text in enumerate(texts):
        chunks = [c for _, c in sorted(got[doc])]
        check_chunks(text, chunks, max_chars)


def test_chunker_on_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    source = {d: t or "" for d, t in docs.collect()}
    got = {}
    for r in chunk_lines(docs, "text").collect():
        got.setdefault(r.doc_id, []).append((r.chunk_idx, r.chunk))
    for d, t in source.items():
        check_chunks(t, [c for _, c in sorted(got[d])], 3500)
    assert sum(len(v) for v in got.values()) == 1312


def test_envelope_and_preview(spark):
    df = spark.createDataFrame([("S", "a\nb" * 150)], "n string, t string")
    r = df.select(site_envelope("n", "t").alias("e")).first().e
    assert r.startswith("--- START SITE: S ---\na\nb") and r.endswith("\n--- END SITE: S ---")
    p = df.select(chunk_preview(F.col("t")).alias("p")).first().p
    assert p == ("a\nb" * 150)[:200].replace("\n", " ")
