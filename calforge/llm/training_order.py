"""Training-order materialisation of token sequences.

Texts become token ids, cut into sequences of STRIDE ids (the last one of a text padded),
and every sequence gets a global slot from a keyed Feistel permutation of its index, with
cycle-walking: a permutation of the smallest power of two that holds all indices is applied
again until it falls below their number. Sequences are dealt out by ranges of slots, and
each range is written in slot order as fixed-stride blocks. So a reader finds slot s at
byte ``(s mod PER_BLOCK) * STRIDE * width`` of block ``s div PER_BLOCK``, reads on in
training order, and resumes at any slot: :func:`read_from` pushes the range down to the files.

The index of a sequence is its place in the table of sequences, which is written once and
never recomputed: files in order of their names, rows in order within each. Only row counts
by file are summed up (a table as long as the list of files), nothing is sorted and no text
is shuffled for it. The permutation depends on the number of sequences and the key alone.

Rows: a null or empty text has no sequence; repeated rows have their own sequences; a null
id is an id; extra columns are ignored; an empty table gives no blocks and an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calforge.llm.common import mix, odd_numbers, steps, stored, utf8
from calforge.session import scratch_path

STRIDE, PER_BLOCK, BLOCKS_PER_RANGE, ROUNDS = 2048, 64, 64, 6
MOST_BROADCAST_FILES = 100_000


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of the indices below ``n``: a keyed permutation of 0..n-1."""
    bits = max(2, int(n - 1).bit_length())
    low = bits // 2
    high = bits - low
    keys = odd_numbers(ROUNDS, key & ((1 << 64) - 1))

    def once(x):
        left, right, a, b = x >> np.uint64(low), x & np.uint64((1 << low) - 1), high, low
        for k in keys:                       # halves may differ in size, so they change places in turn
            with np.errstate(over="ignore"):
                left, right = right, (left ^ mix(right * k + k)) & np.uint64((1 << a) - 1)
            a, b = b, a
        return left << np.uint64(b) | right

    out = once(index.astype(np.uint64))
    while (far := np.flatnonzero(out >= n)).size:
        out[far] = once(out[far])
    return out.astype(np.int64)


def byte_sequences(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, seq, n_tokens, payload`` with bytes as ids (one byte
    each). Other tokenizers give the same columns from their ids (see :func:`id_sequences`)."""
    return id_sequences(docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("ids")), 1, stride)


def id_sequences(coded: DataFrame, width: int, stride: int = STRIDE) -> DataFrame:
    """``doc_id, ids`` (binary, ``width`` bytes an id) -> ``doc_id, seq, n_tokens, payload``."""
    step = width * stride

    def cut(batches):
        for batch in steps(batches, "ids"):
            data, offs = utf8(batch.column("ids"))
            sizes = np.diff(offs)
            n = -(-sizes // step)
            row = np.repeat(np.arange(len(n)), n)
            seq = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            out = np.zeros(len(row) * step, np.uint8)
            at = 0
            for a, z, k in zip(offs[:-1], offs[1:], n, strict=True):
                out[at:at + z - a] = data[a:z]
                at += int(k) * step
            tokens = np.minimum(sizes[row] - seq * step, step) // width
            ends = pa.array(np.arange(0, len(out) + 1, step, dtype=np.int32)) if len(row) else pa.array([0], pa.int32())
            payload = pa.Array.from_buffers(pa.binary(), len(row), [None, ends.buffers()[1], pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(seq), pa.array(tokens), payload],
                                             ["doc_id", "seq", "n_tokens", "payload"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "ids").mapInArrow(cut, f"doc_id {kind}, seq bigint, n_tokens bigint, payload binary")


def indexed(sequences: DataFrame) -> tuple[DataFrame, int]:
    """The written table of sequences with a dense ``index``, and their number."""
    table = stored(sequences, "sequences")
    # the number and row group of a file give its place in the order of names
    rows = table.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = stored(files.select("_file", "_n", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before")), "files")
    n_files, n = before.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    side = before.drop("_n")
    side = F.broadcast(side) if n_files <= MOST_BROADCAST_FILES else side
    return rows.join(side, "_file").withColumn("index", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before"), int(n)


def slot_of(index: Column, n: int, key: int) -> Column:
    @F.pandas_udf("bigint")
    def slot(x: pd.Series) -> pd.Series:
        return pd.Series(permuted(x.to_numpy(np.uint64), n, key))
    return slot(index)


def _block(batches):
    """Rows in slot order -> blocks of PER_BLOCK slots. A block lies in one range, so at most
    one is open from one batch to the next."""
    def row(block, parts):
        return [block, parts[0][0], [p[1] for p in parts], [p[2] for p in parts], [p[3] for p in parts], b"".join(p[4] for p in parts)]

    def out(done):
        cols = list(zip(*done, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(kind)),
                                           pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int64())), pa.array(cols[5], pa.binary())],
                                          ["block", "first_slot", "doc_ids", "seqs", "n_tokens", "payload"])
    opened, parts, done, kind = None, [], [], pa.int64()
    for batch in steps(batches, "payload"):
        kind = batch.column("doc_id").type
        for r in zip(*(batch.column(c).to_pylist() for c in ("slot", "doc_id", "seq", "n_tokens", "payload")), strict=True):
            if r[0] // PER_BLOCK != opened:
                if parts:
                    done.append(row(opened, parts))
                opened, parts = r[0] // PER_BLOCK, []
            parts.append(r)
        if done:
            yield out(done)
            done = []
    if parts:
        yield out([row(opened, parts)])


def write_blocks(sequences: DataFrame, path: str, key: int) -> int:
    """Permute, deal out by ranges of slots, and write blocks; returns the number of sequences."""
    rows, n = indexed(sequences)
    kind = sequences.schema["doc_id"].dataType.simpleString()
    schema = f"block bigint, first_slot bigint, doc_ids array<{kind}>, seqs array<bigint>, n_tokens array<bigint>, payload binary"
    ranges = max(1, -(-n // (PER_BLOCK * BLOCKS_PER_RANGE)))
    placed = rows.withColumn("slot", slot_of(F.col("index"), max(n, 1), key)).select("slot", "doc_id", "seq", "n_tokens", "payload")
    dealt = placed.repartitionById(ranges, F.floor(F.col("slot") / (PER_BLOCK * BLOCKS_PER_RANGE)).cast("int"))
    dealt.sortWithinPartitions("slot").mapInArrow(_block, schema).write.option("compression", "zstd").parquet(path)
    return n


def read_from(spark: SparkSession, path: str, slot: int = 0, until: int | None = None) -> DataFrame:
    """``slot, doc_id, seq, n_tokens, block, at, tokens`` from ``slot`` on (and before
    ``until``); whole blocks before it are not read. ``at`` is the byte offset in the block."""
    blocks = spark.read.parquet(path).where(F.col("block") >= slot // PER_BLOCK)
    if until is not None:
        blocks = blocks.where(F.col("first_slot") < until)
    each = blocks.select("block", "first_slot", "payload", (F.length("payload") / F.size("seqs")).cast("int").alias("size"),
                         F.posexplode(F.arrays_zip("doc_ids", "seqs", "n_tokens")).alias("i", "s"))
    rows = each.select((F.col("first_slot") + F.col("i")).alias("slot"), "s.doc_ids", "s.seqs", "s.n_tokens", "block",
                       (F.col("i") * F.col("size")).cast("bigint").alias("at"),
                       F.col("payload").substr(F.col("i") * F.col("size") + 1, F.col("size")).alias("tokens")) \
        .withColumnsRenamed({"doc_ids": "doc_id", "seqs": "seq"})
    return rows.where(F.col("slot") >= slot) if until is None else rows.where(F.col("slot").between(slot, until - 1))


def materialise(docs: DataFrame, key: int, path: str | None = None) -> DataFrame:
    """Texts -> written blocks, read back in full as one row for each sequence."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "training-order")
    write_blocks(byte_sequences(docs), path, key)
    return read_from(spark, path)
