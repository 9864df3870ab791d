"""A versioned table of rows with a stable key, and upserts into it (ST4).

A version is a list of parts (Parquet folders); its log entry is one small file, which appears
whole or not at all, so readers see a version or the one before it:

    root/_log/<version>/   {"version", "batch", "parts"}
    root/part-<id>/        rows with ``_version``

A merge writes only its own rows as a new part. Reading takes the newest row of each key over all
parts: the highest ``order`` value, then the highest version. After MOST_PARTS parts the merge
writes them as one. A batch that the log already holds is skipped, so a replay changes nothing;
parts without a log entry (of a run that was lost) are never read.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.streaming.upsert import upsert_latest

MOST_PARTS = 8
LOG = "version bigint, batch string, parts array<string>"


def log(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(LOG).json(f"{root}/_log/*")
    except (AnalysisException, Py4JJavaError) as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LOG)


def _last(spark: SparkSession, root: str):
    return log(spark, root).orderBy(F.desc("version")).limit(1).first()


def _rows(spark: SparkSession, root: str, parts: list[str]) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(*[f"{root}/{p}" for p in parts])


def _newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    ranked = rows.withColumn("_rank", F.struct(F.col(order), F.col("_version")))
    return upsert_latest(ranked, key, "_rank").drop("_rank")


def current(spark: SparkSession, root: str, key: str = "uid", order: str = "run", version: int | None = None) -> DataFrame:
    """The table as of its last (or the given) version."""
    at = _last(spark, root) if version is None else log(spark, root).where(F.col("version") == version).first()
    if at is None:
        raise ValueError(f"no version {'' if version is None else version} in {root}")
    return _newest(_rows(spark, root, at["parts"]), key, order).drop("_version")


def merge(batch: DataFrame, root: str, batch_id: str, key: str = "uid", order: str = "run") -> int:
    """Adds the rows of a batch, known by ``batch_id``; returns the table's version. Rows of a key in the batch replace
    the stored one unless theirs is an older ``order``; keys the batch does not hold stay."""
    spark = batch.sparkSession
    last = _last(spark, root)
    if last is not None and log(spark, root).where(F.col("batch") == batch_id).count():
        return last["version"]
    version = 0 if last is None else last["version"] + 1
    own = f"part-{uuid.uuid4().hex}"
    _newest(batch.withColumn("_version", F.lit(version).cast("bigint")), key, order).write.parquet(f"{root}/{own}")
    parts = [*(last["parts"] if last is not None else []), own]
    if len(parts) > MOST_PARTS:
        whole = f"part-{uuid.uuid4().hex}"
        _newest(_rows(spark, root, parts), key, order).write.parquet(f"{root}/{whole}")
        parts = [whole]
    entry = spark.createDataFrame([(version, batch_id, parts)], LOG).coalesce(1)
    entry.write.mode("errorifexists").json(f"{root}/_log/{version:020d}")
    return version


def stream_upsert(df: DataFrame, root: str, key: str = "uid", order: str = "run", checkpoint: str | None = None) -> str:
    """ST4 as a stream: every micro-batch is merged once, whatever fails in between."""
    checkpoint = checkpoint or f"{root}/_checkpoint"          # batch numbers belong to their checkpoint
    q = (df.writeStream.foreachBatch(lambda batch, n: merge(batch, root, f"{checkpoint}#{n}", key, order))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return root


def first_in_order(df: DataFrame, keys=("source_name", "event_key"), order=("chunk_idx", "event_idx"), run: str = "run_at",
                   delay: str = "1 second") -> DataFrame:
    """ST3 in list order: of each run (its time is the event time ``run``) the row of each key that
    comes first by ``order``, whatever order the rows arrive in. The state holds one row a key, the
    first so far; a run's rows come out when the watermark passes it, that is with a run that is
    later by more than ``delay`` (above 0, or a run would close with its first batch), and its state
    goes. Equal to the batch's first-wins (``dedup_within_source``)."""
    cols = [c for c in df.columns if c not in (*keys, run)]
    first: Column = F.min_by(F.struct(*cols), F.struct(*order))
    return (df.withWatermark(run, delay).groupBy(run, *keys).agg(first.alias("_first"))
            .select(run, *keys, *[F.col(f"_first.{c}").alias(c) for c in cols]))
