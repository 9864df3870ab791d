"""Source registry: scan, names, enabled filter, profile dispatch (SC1, SC2, J1, J2).

Registry rows: ``rank BIGINT`` (position in the registry, the run order), ``name``,
``url``, ``enabled BOOLEAN`` (NULL = not given).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calforge.operators.ordinal import dense_index

SOURCE_TYPE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
])
CONFIG_SCHEMA = T.StructType([T.StructField("sources", T.ArrayType(SOURCE_TYPE))])

# Extraction profiles and the default for a name without an entry.
PROFILES = ("generic", "cards", "items", "lines", "frame")
DEFAULT_PROFILE = "generic"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """SC1, config form: one JSON object ``{"sources": [{name, url, enabled}, ...]}``
    per file, read with an explicit schema. A missing/unreadable list yields no rows
    (PERMISSIVE mode), the rank is the list position."""
    try:
        raw = spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    except AnalysisException:  # missing config -> no sources
        raw = spark.createDataFrame([], CONFIG_SCHEMA)
    exploded = raw.select(F.posexplode(F.coalesce("sources", F.array().cast(T.ArrayType(SOURCE_TYPE))))
                          .alias("rank", "s"))
    return exploded.select(F.col("rank").cast("bigint").alias("rank"), "s.name", "s.url", "s.enabled")


def read_registry_lines(spark: SparkSession, path: str, order_col: str = "rank") -> DataFrame:
    """SC1, scalable form: JSON lines, one source per line, with an explicit order
    column; rank = dense position in that order (no single-task numbering)."""
    schema = T.StructType([T.StructField(order_col, T.LongType()), *SOURCE_TYPE.fields])
    df = spark.read.schema(schema).json(path)
    if order_col == "rank":
        df = df.withColumnRenamed("rank", "_order")
        order_col = "_order"
    return dense_index(df, order_col, "rank").select("rank", "name", "url", "enabled")


def source_names(registry: DataFrame) -> DataFrame:
    """SC2: names in registry order, empty/NULL names dropped, repeats kept."""
    return registry.where(F.coalesce(F.col("name"), F.lit("")) != "").select("rank", "name")


def enabled_sources(registry: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """With a manual list, membership alone decides (the flag is ignored, an
    empty list selects nothing); without one, ``enabled`` with default false.
    The list is a left-semi join; AQE broadcasts it when its measured size is small."""
    if override is None:
        return registry.where(F.coalesce(F.col("enabled"), F.lit(False)))
    names = override.select(F.col(override.columns[0]).alias("name")).where(F.col("name").isNotNull())
    return registry.join(names, "name", "left_semi").select(*registry.columns)


def source_profile(registry: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each source's extraction profile by name, else the generic one. The
    profile table is a configuration list (one row per name, the first by value wins where a name repeats)."""
    p = profiles.groupBy("name").agg(F.min("profile").alias("profile"))
    return (registry.join(p, "name", "left")
            .withColumn("profile", F.coalesce(F.col("profile"), F.lit(DEFAULT_PROFILE)))
            .select(*registry.columns, "profile"))
