"""Upserts into a versioned table, and first-wins of a stream in list order."""

import random

import pytest
from pyspark.sql import functions as F

from calforge.operators import events as E
from calforge.plans import fixtures as FX
from calforge.session import scratch_path
from calforge.streaming import stream as ST
from calforge.streaming import versions as V
from tests.conftest import SF001, rows

COLS = "uid string, title string, run int"


def table(spark, root):
    return rows(V.current(spark, root).select("uid", "title", "run"))


def test_new_changed_and_vanished_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no version"):
        V.current(spark, root)
    one = spark.createDataFrame([("a", "A", 1), ("b", "B", 1), ("c", "C", 1)], COLS)
    two = spark.createDataFrame([("b", "B2", 2), ("c", "C", 2), ("d", "D", 2), ("d", "D", 2)], COLS)
    assert V.merge(one, root, "1") == 0 and V.merge(two, root, "2") == 1
    want = [("a", "A", 1), ("b", "B2", 2), ("c", "C", 2), ("d", "D", 2)]
    assert table(spark, root) == want
    # a replay, an older run that comes late, and a look at the version before
    assert V.merge(two, root, "2") == 1 and V.merge(one, root, "1") == 1 and V.log(spark, root).count() == 2
    V.merge(spark.createDataFrame([("b", "old", 0), ("e", "E", 0)], COLS), root, "3")
    assert table(spark, root) == [*want, ("e", "E", 0)]
    assert rows(V.current(spark, root, version=0).select("uid", "title", "run")) == [("a", "A", 1), ("b", "B", 1), ("c", "C", 1)]
    # a part that a lost run left behind is not read
    spark.createDataFrame([("z", "lost", 9, 9)], COLS + ", _version bigint").write.parquet(f"{root}/part-lost")
    assert table(spark, root) == [*want, ("e", "E", 0)]


def test_many_batches_equal_a_dictionary(spark, tmp_path):
    root, rng, want = str(tmp_path / "t"), random.Random(2), {}
    for batch in range(V.MOST_PARTS + 4):
        made = [(f"u{rng.randint(0, 12)}", f"t{batch}.{i}", batch // 2) for i in range(6)]
        made = list({r[0]: r for r in made}.values())
        V.merge(spark.createDataFrame(made, COLS), root, str(batch))
        want.update({r[0]: r for r in made if r[0] not in want or r[2] >= want[r[0]][2]})
    assert table(spark, root) == sorted(want.values())
    last = V.log(spark, root).orderBy(F.desc("version")).first()
    assert last["version"] == V.MOST_PARTS + 3 and len(last["parts"]) <= V.MOST_PARTS


def test_a_stream_of_runs_is_merged_once(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "t")
    runs = [[("a", "A", 1), ("b", "B", 1)], [("b", "B2", 2), ("c", "C", 2)], [("a", "A3", 3)]]
    for made in runs[:2]:
        spark.createDataFrame(made, COLS).coalesce(1).write.mode("append").parquet(landing)
    stream = ST.read_landing(spark, landing, spark.read.parquet(landing).schema, max_files=1)
    V.stream_upsert(stream, root)
    assert table(spark, root) == [("a", "A", 1), ("b", "B2", 2), ("c", "C", 2)] and V.log(spark, root).count() == 2
    V.stream_upsert(stream, root)                                  # nothing new has landed
    assert V.log(spark, root).count() == 2
    spark.createDataFrame(runs[2], COLS).coalesce(1).write.mode("append").parquet(landing)
    V.stream_upsert(stream, root)
    assert table(spark, root) == [("a", "A3", 3), ("b", "B2", 2), ("c", "C", 2)] and V.log(spark, root).count() == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_first_wins_of_a_stream_whatever_the_arrival(spark, seed):
    cand = E.drop_past(E.with_event_key(E.with_event_date(E.classify_category(FX.fx4_candidates(spark, SF001)))), FX.AS_OF)
    keys, cols = ("source_rank", "source_name", "event_key"), ("source_rank", "event_key", "chunk_idx", "event_idx")
    landing = scratch_path(spark, "landing-shuffled")
    timed = cand.withColumn("run_at", F.lit("2024-01-10 06:00:00").cast("timestamp")).repartition(5, F.xxhash64("event_id", F.lit(seed)))
    timed.orderBy(F.desc("event_id")).coalesce(1).write.option("maxRecordsPerFile", 120).parquet(landing)
    timed.limit(1).withColumn("run_at", F.lit("2024-01-12 06:00:00").cast("timestamp")).coalesce(1).write.mode("append").parquet(landing)
    stream = ST.read_landing(spark, landing, spark.read.parquet(landing).schema, max_files=1)
    out = spark.read.parquet(ST.run_available(V.first_in_order(stream, keys), spark, "first-test"))
    assert rows(out, *cols) == rows(E.dedup_within_source(cand, FX.AS_OF), *cols)
