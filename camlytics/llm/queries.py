"""Registered queries of the pipeline's operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camlytics.llm import chat, decontaminate, jaccard, language, lm, mixing, nearest, periodic, repair, secret_scan, shard, token_file, tokens
from camlytics.llm.common import table

TOKENIZER, SUBWORDS = "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shard.assign(table(spark, sf, "documents"))


def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf, "documents"), judge=secret_scan.held)


def op4_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return lm.score(table(spark, sf, "documents"), public_tokenizers.path(SUBWORDS))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return nearest.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.perspectives(table(spark, sf, "conversations"))


def op9_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(table(spark, sf, "documents"))


def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.language_of(table(spark, sf, "documents"))


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    conversations = table(spark, sf, "conversations")
    return repair.audit(repair.damaged(conversations), among=conversations)


def op12_token_file(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_file.report(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.digests(table(spark, sf, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_sharding, op3_secret_scan, op4_lm_scoring, op5_token_counts, op6_mixing, op7_nearest, op8_chat,
        op9_ngram_jaccard, op10_language_id, op11_conversation_repair, op12_token_file, op13_periodic_runs,
    )
}
ORACLE: dict[str, str] = {"op6_mixing": mixing.ORACLE, "op8_chat": chat.ORACLE, "op9_ngram_jaccard": jaccard.ORACLE}
