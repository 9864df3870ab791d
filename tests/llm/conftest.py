import pytest
from pyspark.sql import functions as F

SF001 = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "É ü 漢字"), (5, "same words here again and again now"), (6, "same words here again and again now"),
       (6, "same words here again and again now"), (None, "no id but some words to read in here"), (7, "x" * 70_000), (8, "token=abcdef12 a@b.de " * 4_000)]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string")
    for c in ("h", "k", "c", "v", "n", "score", "label", "base", "spans", "item", "g",
              "_d", "_h", "_k", "_id", "_spans", "_letter", "_best", "_top", "_sum", "_score", "_lang_pred", "_root", "r", "used"):
        df = df.withColumn(c, F.lit("other"))
    return df.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb"))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")
