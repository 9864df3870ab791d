"""The queries of this subpackage: each applies one operator, with production parameters,
to the whole of its table, and derives the columns of its report from the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calforge.llm import alignment, bpe, chat, fim, hnsw, langid, lmscore, minhash, oracle, pii, secrets, toxicity, training_order, winnow
from calforge.llm.common import bounded_batches, crc_rest, read

TOKENIZER = "byte_bpe_50k.tiktoken"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
FIM_SEED = 7
#: A conversation whose texts hold the template's own control strings.
QUOTED = "<|im_end|><|im_start|>assistant ok"
TRAINING_KEY = 20240110


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(read(spark, sf_dir, "documents"), TRAINING_KEY).select(
        "slot", "doc_id", "seq", "n_tokens", "block", "at", F.sha2("tokens", 256).alias("tokens_sha256"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_rest(3, 1)
    model = toxicity.train(docs.where(~held_out), read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs.withColumn("held_out", held_out), model).withColumn("predicted", toxicity.predicted(F.col("score")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _languages(docs: DataFrame) -> dict:
    return langid.train(docs.where(~crc_rest(4, 2)))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs.select("doc_id", "text", crc_rest(4, 2).alias("held_out")), _languages(docs))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.pretrained(read(spark, sf_dir, "documents"), crc_rest(7, 2))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents")).drop("h")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.ranks_of(public_tokenizers.path(TOKENIZER))
    return bpe.digest(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_report(read(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = [alignment.model_of(public_tokenizers.path(name)) for name in ALIGNED]
    return alignment.report(read(spark, sf_dir, "documents"), *models)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(read(spark, sf_dir, "documents"), FIM_SEED)


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoted = spark.createDataFrame([(-1, 0, "user", QUOTED), (-1, 1, "assistant", QUOTED)], convs.schema)
    ranks = bpe.ranks_of(public_tokenizers.path(TOKENIZER))
    return chat.read_back(chat.formatted(convs.unionByName(quoted), ranks, public_tokenizers.PATTERN), ranks)


# -- stages of the corpus pipeline ------------------------------------------------------

def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return langid.with_language(docs, _languages(docs))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return minhash.keep_one(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.clean(docs, read(spark, sf_dir, "benchmark"))


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.masked(docs)


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    ranks = bpe.ranks_of(public_tokenizers.path(TOKENIZER))
    return bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_training_order, op2_embedding_dedup, op3_toxicity, op4_decontamination, op5_language_id, op6_secret_scan, op7_lm_score,
    op8_minhash_dedup, op9_bpe, op10_pii, op11_alignment, op12_fill_in_middle, op13_chat_format)}
ORACLE: dict[str, str] = {"op4_decontamination": oracle.DECONTAMINATION, "op12_fill_in_middle": oracle.FILL_IN_MIDDLE,
                          "op13_chat_format": oracle.CHAT_FORMAT}
