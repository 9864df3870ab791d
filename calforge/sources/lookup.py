"""Reading few rows of a wide table by key, without moving the table.

A semi-join whose wide side holds page html must not shuffle it. The wanted keys are counted
first (they are a stored table). Up to MOST_SENT keys go out to every task and the wide side is
filtered in place. Beyond that the keys become bitmaps over their hashes, FILTER_BITS bits in
all (16 MB, whatever the number of keys): they filter in place too, and only the rows that pass,
the wanted ones and a few by chance, are shuffled for the exact semi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that are sent to every task: 8 bytes each.
MOST_SENT = 1_000_000
#: Size of the filter beyond that: rows pass by chance at a rate of keys / FILTER_BITS.
FILTER_BITS = 1 << 27


def few(keys: DataFrame, most: int = MOST_SENT) -> bool:
    """Whether a stored table of keys is small enough to be sent (its rows are counted)."""
    return keys.count() <= most


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def _maybe(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key has its bit in the keys' bitmaps."""
    bit = _bit(F.col(keys.columns[0]))
    maps = keys.groupBy(F.bitmap_bucket_number(bit).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bitmap"))
    at = F.bitmap_bit_position(_bit(F.col(key)))
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    found = df.join(F.broadcast(maps), F.bitmap_bucket_number(_bit(F.col(key))) == F.col("_bucket"))
    return found.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("_bucket", "_bitmap")


def rows_with_keys(df: DataFrame, key: str, keys: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among ``keys`` (a stored one-column table; null matches
    nothing). Only rows that pass a filter in place are ever shuffled."""
    named = keys.select(F.col(keys.columns[0]).alias("_key"))
    if few(keys, most):
        if dict(keys.dtypes)[keys.columns[0]] in ("bigint", "int"):
            return df.join(F.broadcast(named), F.col(key) == F.col("_key"), "left_semi")
        hashes = named.select(F.xxhash64("_key").alias("_hash")).distinct()
        passed = df.join(F.broadcast(hashes), F.xxhash64(key) == F.col("_hash"), "left_semi")
    else:
        passed = _maybe(df, key, named)
    # an inner join with distinct keys: a semi-join would be pushed below the filter in place
    return passed.join(named.distinct(), F.col(key) == F.col("_key")).drop("_key")
