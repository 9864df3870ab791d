"""Structured Streaming versions (ST1-ST3).

The per-row operators (page text, card text, envelope, chunking, native extraction,
classification, date parsing, keys) are stateless, so the incremental run applies
the very same expressions to every micro-batch of newly landed pages. State is only
needed for de-duplication across batches, bounded by an event-time watermark.

Every query takes its checkpoint location from the shared folder; ``availableNow``
processes what has landed and stops, which is how a scheduled incremental run works.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from calforge.operators import events as E
from calforge.operators import extract as X
from calforge.plans import gather as G
from calforge.session import scratch_path


def read_landing(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """New Parquet files in a landing folder as a stream (explicit schema)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


#: Micro-batches that a landing is taken in, and files that one is written as (about, beyond small ones).
BATCHES, LANDED_FILES = 8, 256


def records_a_file(rows: int, least: int) -> int:
    """Rows of a landed file, so that the number of files does not grow with the landing."""
    return max(least, math.ceil(rows / LANDED_FILES))


def files_a_batch(spark: SparkSession, path: str, batches: int = BATCHES) -> int:
    """``max_files`` that takes what has landed in about ``batches`` micro-batches: each has a fixed
    cost (its log entries, a commit of every state partition), whatever it holds."""
    return max(1, math.ceil(len(spark.read.parquet(path).inputFiles()) / batches))


def page_candidates(card_pages: DataFrame, source_rank: int = 0, source_name: str = "listing",
                    place: str = "braunschweig") -> DataFrame:
    """ST1 transform: card listing pages -> per-page card text -> envelope -> chunks
    -> native extraction -> candidates with category/date/key. Row-local, so it is
    the same for a batch DataFrame and a streaming one. Each page is its own text
    unit (``chunk_idx = page * stride + local``)."""
    units = card_pages.select(F.lit(source_rank).cast("bigint").alias("source_rank"),
                              F.lit(source_name).alias("source_name"), "page",
                              G.card_text("html", place).alias("text"))
    units = units.where(F.col("text") != "")
    cand = X.extract_native(G.units_to_chunks(units, halo=X.HALO))
    return E.with_event_key(E.with_event_date(E.classify_category(cand)))


def run_available(df: DataFrame, spark: SparkSession, name: str, out_path: str | None = None,
                  checkpoint: str | None = None) -> str:
    """Run a streaming DataFrame to completion of the landed data into Parquet."""
    out_path = out_path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or f"{out_path}/_checkpoint"      # a second run goes on where the first ended
    q = (df.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def stream_event_feed(df: DataFrame, spark: SparkSession, table_path: str, checkpoint: str | None = None) -> str:
    """ST2: push every micro-batch's events as soon as it is ready (``foreachBatch``
    appends them, tagged with the batch id, to a table in the shared folder). A
    replayed batch after a failure rewrites only its own batch folder (idempotent)."""
    checkpoint = checkpoint or f"{table_path}/_checkpoint"    # belongs to the table: batch ids go on

    def push(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(table_path))

    q = (df.writeStream.foreachBatch(push).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table_path


def stream_dedup(df: DataFrame, keys=("source_name", "event_key"), delay: str = "1 day") -> DataFrame:
    """ST3: cross-batch first-arrival dedup. The watermark follows the time of arrival:
    events lie in the future and come in any order of their own dates, so none is late."""
    arrived = df.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    return arrived.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")
