"""Extraction calls under control (X5, X6): timeout, retry, a status for every chunk, stored answers.

A call that raises, answers in a wrong form or takes longer than ``CallPolicy.timeout`` is tried
again, ``attempts`` times in all. What became of it is a row of the answer store:

    chunk_hash, response, status (ok | invalid | timeout | failed), attempts, error, run

The store is a Parquet folder on shared storage. Chunks are known by the hash of their text, so a
rerun calls only for chunks that have no good answer yet, and equal chunks are called for once.
Calls are dealt out ``calls_per_task`` to a task: a lost executor costs the calls of its running
tasks, a call that hangs costs its chunk and the time of its attempts.
"""

from __future__ import annotations

import json
import math
import queue
import threading
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.session import stored_table

KEYS = ("source_rank", "source_name", "chunk_idx")
STORE = "chunk_hash string, response string, status string, attempts int, error string, run int"
STATUSES = ("ok", "invalid", "timeout", "failed")


@dataclass(frozen=True)
class CallPolicy:
    """``timeout`` in seconds of one call, ``attempts`` in all, ``calls_per_task``."""
    timeout: float = 90.0
    attempts: int = 2
    calls_per_task: int = 200


def well_formed(answer) -> bool:
    """Whether an answer has the form that ``parse_event_json`` takes: ``{"events": [...]}``, every
    event with five text fields and a category."""
    try:
        events = json.loads(answer)["events"]
        return isinstance(events, list) and all(
            "category" in e and all(isinstance(e[f], str) for f in ("title", "date", "time", "location", "description")) for e in events)
    except (TypeError, ValueError, KeyError):
        return False


def within(seconds: float, call: Callable, *args):
    """The call's result, or TimeoutError. A call that hangs is left to a daemon thread."""
    box: queue.SimpleQueue = queue.SimpleQueue()

    def run():
        try:
            box.put((call(*args), None))
        except Exception as e:  # noqa: BLE001 - handed to the caller
            box.put((None, e))

    threading.Thread(target=run, daemon=True).start()
    try:
        value, error = box.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no answer within {seconds} s") from None
    if error is not None:
        raise error
    return value


def attempt(extractor: Callable[[str], str], text: str, policy: CallPolicy, first=None) -> tuple:
    """``(response, status, attempts, error)`` of one chunk; ``first`` is an answer that a batch
    call already gave."""
    outcome = (None, "failed", 0, None)
    for n in range(1, policy.attempts + 1):
        try:
            answer = first if n == 1 and first is not None else within(policy.timeout, extractor, text)
        except TimeoutError as e:
            outcome = (None, "timeout", n, str(e))
            continue
        except Exception as e:  # noqa: BLE001 - a failed call empties this chunk only
            outcome = (None, "failed", n, f"{type(e).__name__}: {e}"[:500])
            continue
        if well_formed(answer):
            return answer, "ok", n, None
        outcome = (answer if isinstance(answer, str) else None, "invalid", n, "not an answer of events")
    return outcome


def _caller(extractor, policy: CallPolicy, run: int):
    def rows(batches):
        batch_call = getattr(extractor, "extract_batch", None)
        for pdf in batches:
            texts = list(pdf["chunk"])
            firsts = [None] * len(texts)
            if batch_call is not None and texts:
                try:      # one call for the batch counts as the first attempt of each chunk
                    answers = list(within(policy.timeout, batch_call, texts))
                    firsts = answers if len(answers) == len(texts) else firsts
                except Exception:  # noqa: BLE001 - call by call instead
                    pass
            made = [attempt(extractor, t, policy, f) for t, f in zip(texts, firsts, strict=True)]
            out = pd.DataFrame(made, columns=["response", "status", "attempts", "error"])
            out.insert(0, "chunk_hash", list(pdf["chunk_hash"]))
            yield out.assign(run=run)

    return rows


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an answer store; none if it does not exist yet."""
    try:
        return spark.read.schema(STORE).parquet(path)
    except (AnalysisException, Py4JJavaError) as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], STORE)


def latest(store: DataFrame) -> DataFrame:
    """One row per chunk text: its good answer, or the outcome of its last run."""
    row = F.struct(*[c for c in store.columns if c != "chunk_hash"])
    return store.groupBy("chunk_hash").agg(
        F.max_by(row, F.struct((F.col("status") == "ok").alias("ok"), F.col("run"))).alias("r")).select("chunk_hash", "r.*")


def call(chunks: DataFrame, extractor: Callable[[str], str], store: str, policy: CallPolicy = CallPolicy(),
         keys=KEYS) -> DataFrame:
    """Calls for every chunk text without a good answer in ``store`` and adds the outcomes to it.
    Returns ``keys, chunk_hash, response, status, attempts, error, run`` for every chunk: the good
    answer, or what became of the last run's calls. A null chunk is an empty one."""
    spark = chunks.sparkSession
    hashed = chunks.select(*keys, F.coalesce("chunk", F.lit("")).alias("chunk")).withColumn("chunk_hash", F.sha2("chunk", 256))
    hashed = stored_table(hashed, "chunks")      # read for the count, the calls and the answers: its lineage runs once
    known = read_store(spark, store)
    run = (known.agg(F.max("run")).first()[0] or 0) + 1
    todo = hashed.groupBy("chunk_hash").agg(F.min("chunk").alias("chunk")).join(
        known.where("status = 'ok'").select("chunk_hash"), "chunk_hash", "left_anti")
    n = todo.count()
    if n:
        tasks = max(1, math.ceil(n / policy.calls_per_task))
        todo.repartition(tasks, "chunk_hash").mapInPandas(_caller(extractor, policy, run), STORE).write.mode("append").parquet(store)
    # each chunk text has one answer; a text that is a third of all chunks is split by AQE
    return hashed.drop("chunk").join(latest(read_store(spark, store)), "chunk_hash", "left").select(
        *keys, "chunk_hash", "response", "status", "attempts", "error", "run")


def call_report(outcomes: DataFrame) -> DataFrame:
    """Per source (NULL: all): chunks, and how many ended in each status or took more than one attempt."""
    return outcomes.rollup("source_name").agg(
        F.count(F.lit(1)).alias("n_chunks"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.count_if(F.col("attempts") > 1).alias("retried"))
