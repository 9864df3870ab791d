"""From raw documents to training tokens: language, near-dedup, decontamination, secrets, BPE.

Each stage takes the rows its predecessor kept and returns the columns of ``documents``;
the last returns tokens. Decisions take effect: documents in no learned language go, one
document of each near-duplicate group stays, documents that share a window with the
benchmark go, and secrets are masked in place. Every stage's result is written to the
shared folder and read again, so a lost executor costs no more than its running tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from calforge.llm import queries as Q
from calforge.llm.common import read, stored

STAGES = [
    ("language", Q.stage_language),
    ("near_dedup", Q.stage_near_dedup),
    ("decontaminate", Q.stage_decontaminate),
    ("secrets", Q.stage_secrets),
    ("tokens", Q.stage_tokens),
]

#: Language models, near-duplicate components and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
