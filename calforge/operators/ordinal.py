"""Dense 0-based position of rows in a total order, without a global window.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Here the rows are
range-partitioned on ``k`` and sorted inside each partition; ``monotonically_increasing_id``
then holds (partition, position) and only one count per partition - a table whose
size is bounded by the partition count, not by the data - is prefix-summed and
broadcast to turn local positions into global ones. ``k`` (one column or several) should be
unique: rows of equal ``k`` get positions next to each other, in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calforge.session import scratch_path

_LOW_BITS = (1 << 33) - 1


def dense_index(df: DataFrame, order_col: str | Sequence[str], out: str, num_partitions: int | None = None) -> DataFrame:
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ids = (ranged.sortWithinPartitions(*order)
           .withColumn("_mid", F.monotonically_increasing_id())
           .withColumn("_part", F.shiftrightunsigned("_mid", 33))
           .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))))
    # Written once: both branches below must see the very same partitions and positions
    # (planned twice, sampling and coalescing could cut the ranges differently).
    path = scratch_path(df.sparkSession, "dense-index")
    ids.write.parquet(path)
    ids = df.sparkSession.read.schema(ids.schema).parquet(path)
    counts = ids.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-task window over it is bounded by the partition count
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    return (ids.join(F.broadcast(offsets), "_part")
            .withColumn(out, (F.col("_pos") + F.col("_off")).cast("bigint"))
            .drop("_mid", "_part", "_pos", "_off"))
