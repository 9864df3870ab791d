"""Shuffle files of written steps: gone when the step is, with the same rows however often it is written."""

import time

from pyspark.sql import functions as F

from calforge.llm.common import SHUFFLES_GO, stored


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def _left_over(spark, before):
    """New shuffle files; Spark takes them away in the background, so this waits a little."""
    for _ in range(50):
        if not (new := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return new


def test_stored_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = spark.range(4000).withColumn("k", F.col("id") % 7)
    pairs = rows.join(rows.groupBy("k").agg(F.max("id").alias("top")).hint("merge"), "k")
    first, again = stored(pairs, "first"), stored(pairs, "again")
    assert not _left_over(spark, before)
    assert first.count() == again.count() == 4000
    assert first.exceptAll(again).isEmpty() and first.exceptAll(pairs).isEmpty()


def test_stored_keeps_the_session_as_it_was(spark):
    assert SHUFFLES_GO not in spark.conf.getAll
    stored(spark.range(3), "some")
    assert SHUFFLES_GO not in spark.conf.getAll
    spark.conf.set(SHUFFLES_GO, "false")
    try:
        stored(spark.range(3), "some")
        assert spark.conf.get(SHUFFLES_GO) == "false"
    finally:
        spark.conf.unset(SHUFFLES_GO)
