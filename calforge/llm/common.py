"""Helpers shared by the operators of this subpackage.

Row handling that every operator follows, unless its docstring says otherwise:
a null text is an empty text, a null ``doc_id`` is a value like any other, repeated
rows stay repeated, other columns of the input are ignored (operators select what
they need by name; those that keep all columns name their own by :func:`free`, so extra
columns with clashing names do no harm), and an empty
table gives an empty result with the same schema.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.session import scratch_path

#: Bytes of text that one step of a vectorised pass holds at once (a longer text is a step of its own).
STEP_BYTES = 1 << 20


#: Rows and bytes of an Arrow batch between Spark and Python, and rows of a batch of the Parquet reader, where the session does not say.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
           "spark.sql.parquet.columnarReaderBatchSize": "512"}


#: Setting by which the shuffle files of a query go at its end. Else they stay until the driver happens to collect its
#: garbage, and an operator of many steps keeps those of all its steps on disk.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded_batches(spark: SparkSession) -> None:
    """Batches of texts by their bytes: with the default of 10,000 rows, and no bound in bytes,
    a batch of long texts is held several times on both sides of every Python stage; with that
    of 4,096 rows in the Parquet reader the texts of a batch are one array of tens of megabytes,
    in every task that scans them."""
    said = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in said:
            spark.conf.set(key, value)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage ends at files that
    every executor can reach, so a lost executor costs no recomputation. The shuffle files
    of the write go when it ends; a write is planned anew each time, so nothing reads them again."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    said = SHUFFLES_GO in spark.conf.getAll
    if not said:
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        if not said:
            spark.conf.unset(SHUFFLES_GO)
    return spark.read.schema(df.schema).parquet(path)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of the GNU C library
    if trim:
        trim(0)


def tidy(body: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``body`` for ``mapInArrow``, with the memory that it freed given back to the system at its end:
    workers are kept for later tasks, and an idle one counts against its executor in full."""
    def run(batches):
        yield from body(batches)
        _give_back()
    return run


def crc_rest(mod: int, rest: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod``, equals ``rest``; a null id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == rest, F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable: it is computed once however often ``body``
    (or a lambda inside it) uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as keep it apart from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def row_key(*cols: str) -> Column:
    return F.xxhash64(*cols)


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 row offsets of an Arrow string or binary column; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    kind = pa.large_string() if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else pa.large_binary()
    arr = arr.cast(kind)
    if arr.null_count:
        arr = pc.fill_null(arr, "" if kind == pa.large_string() else b"")
    buf = arr.buffers()
    offs = np.frombuffer(buf[1], np.int64, len(arr) + 1, arr.offset * 8) if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(buf[2], np.uint8) if buf[2] is not None and buf[2].size else np.zeros(0, np.uint8)
    return data, offs


def steps(batches: Iterable[pa.RecordBatch], column: str, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``size`` bytes in each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offs = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers from ``seed``."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)
