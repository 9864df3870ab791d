"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

A text of up to CHUNK characters is one piece. A longer one is cut into chunks that overlap
by OVERLAP characters; the chunks are dealt out and pre-tokenised in parallel, each from
its own start. Where a chunk and the one before it have a pre-token boundary in common
within the overlap they have resynchronised: the pattern looks at nothing behind it, so
from there on both go on alike, and the chunk's text is cut there. Chunks count only as far
as each has resynchronised with the one before (a run of letters longer than the overlap
holds no boundary); what follows then stays one piece. Pieces are dealt out again and
encoded, and their ids put together in order. Decoding concatenates the raw bytes of ids.

Rows: a null text is empty and has no ids; repeated rows come out as often as they came
in; null ids of documents are kept; extra columns are ignored; an empty table gives an
empty result. Ids are little-endian unsigned 32-bit integers in one binary value.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calforge.llm.common import steps, tidy, utf8

CHUNK, OVERLAP, MARGIN = 1 << 16, 1 << 10, 8


def ranks_of(path: str) -> bytes:
    """The rank file as it is: a token in base64 and its rank on each line."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=2)
def _bytes_by_id(ranks: bytes) -> list[bytes]:
    table = {int(b): base64.b64decode(a) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return [table.get(i, b"") for i in range(max(table) + 1)]


def _encoder(sent, pattern: str):
    def encode(batches):
        enc = _encoding(sent.value, pattern)
        for batch in steps(batches, "text"):
            data, offs = utf8(batch.column("text"))
            raw, ends, n = [], [0], []
            for a, z in zip(offs[:-1], offs[1:], strict=True):
                ids = np.array(enc.encode_ordinary(data[a:z].tobytes().decode()), "<u4")
                n.append(len(ids))
                raw.append(ids.tobytes())
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n, pa.int64()), pa.array(raw, pa.binary())],
                                             [*names, "n_tokens", "ids"])
    return encode


def _boundaries(pattern: str):
    """Ends of pre-tokens near both ends of a chunk, as positions in the whole text."""
    def find(batches):
        pat = regex.compile(pattern)
        for batch in batches:
            head, tail = [], []
            for at, text in zip(batch.column("at").to_pylist(), batch.column("chunk").to_pylist(), strict=True):
                ends = np.array([m.end() for m in pat.finditer(text)], np.int64)
                ends = ends[ends <= len(text) - MARGIN]
                head.append((ends[ends < OVERLAP] + at).tolist())
                tail.append((ends[ends >= CHUNK] + at).tolist())
            names = [c for c in batch.schema.names if c != "chunk"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(head, pa.list_(pa.int64())),
                                              pa.array(tail, pa.list_(pa.int64()))], [*names, "head", "tail"])
    return find


def pieces(docs: DataFrame, pattern: str) -> DataFrame:
    """``doc_id, k, text`` of long texts -> ``doc_id, k, piece, text``: cut where chunks resynchronise."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / CHUNK).cast("int"))
    chunks = docs.select("doc_id", "k", "text", F.explode(starts).alias("c")) \
        .select("doc_id", "k", "c", (F.col("c").cast("bigint") * CHUNK).alias("at"),
                F.substring("text", F.col("c") * CHUNK + 1, F.lit(CHUNK + OVERLAP)).alias("chunk"))
    found = chunks.repartition("doc_id", "k", "c").mapInArrow(
        _boundaries(pattern), f"doc_id {kind}, k bigint, c int, at bigint, head array<bigint>, tail array<bigint>")
    order = Window.partitionBy("doc_id", "k").orderBy("c")
    cut = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    met = found.withColumn("cut", F.when(F.col("c") == 0, F.lit(0)).otherwise(cut))
    good = met.withColumn("whole", F.min(F.col("cut").isNotNull()).over(order.rowsBetween(Window.unboundedPreceding, 0))).where("whole")
    cuts = good.groupBy("doc_id", "k").agg(F.array_sort(F.collect_list("cut")).alias("cuts")) \
        .withColumnsRenamed({"doc_id": "_d", "k": "_k"})
    both = docs.join(cuts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k")))
    return both.select("doc_id", "k", "text", "cuts", F.posexplode("cuts").alias("piece", "lo")).select(
        "doc_id", "k", "piece", F.col("text").substr(
            (F.col("lo") + 1).cast("int"), (F.coalesce(F.get("cuts", F.col("piece") + 1), F.length("text")) - F.col("lo")).cast("int")).alias("text"))


def _join_pieces(batches):
    for batch in batches:
        ids = [b"".join(p["ids"] for p in parts) for parts in batch.column("parts").to_pylist()]
        names = [c for c in batch.schema.names if c != "parts"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                          pa.array(ids, pa.binary())], [*names, "n_tokens", "ids"])


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_tokens, ids`` for every row. ``ranks`` is a rank file
    (a bounded table of the tokenizer)."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = docs.schema["doc_id"].dataType.simpleString()
    t = docs.select("doc_id", "text")
    long = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    short = t.where(~long).mapInArrow(tidy(_encoder(sent, pattern)), f"doc_id {kind}, n_tokens bigint, ids binary")
    copies = t.where(long).select("doc_id", F.xxhash64("text").alias("k"), "text")
    single = copies.dropDuplicates(["doc_id", "k"])
    coded = pieces(single, pattern).repartition("doc_id", "k", "piece").mapInArrow(
        tidy(_encoder(sent, pattern)), f"doc_id {kind}, k bigint, piece int, n_tokens bigint, ids binary")
    whole = coded.groupBy("doc_id", "k").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts")) \
        .mapInArrow(_join_pieces, f"doc_id {kind}, k bigint, n_tokens bigint, ids binary").withColumnsRenamed({"doc_id": "_d", "k": "_k"})
    back = copies.select("doc_id", "k").join(whole, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k")))
    return short.unionByName(back.select("doc_id", "n_tokens", "ids"))


def decode(coded: DataFrame, ranks: bytes) -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of the ids, concatenated."""
    sent = coded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        table = _bytes_by_id(sent.value)
        for batch in steps(batches, "ids"):
            data, offs = utf8(batch.column("ids"))
            out = [b"".join([table[i] for i in np.frombuffer(data[a:z].tobytes(), "<u4").tolist()]) for a, z in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(tidy(run), f"{kept}, decoded binary")


def digest(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Encoding and decoding of every text, with digests of both."""
    return decode(encode(docs, ranks, pattern), ranks).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
