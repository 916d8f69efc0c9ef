"""Queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, language, preference, quality, rules, secrets, simhash, tokenids, warc
from tidemark.llm.common import read, scratch


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op1_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.rendered(preference.against_truncated(read(spark, sf_dir, "conversations")))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shards = tokenids.write(read(spark, sf_dir, "documents"), scratch(spark, "ids"), public_tokenizers.path("word_bpe_49k.json"))
    return tokenids.read(spark, shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(warc.planned(read(spark, sf_dir, "pages")), scratch(spark, "warc"))
    return warc.summaries(warc.read_chunks(spark, archives, with_data=False))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.scored(docs, model).withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predicted(docs, language.fit(docs))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(read(spark, sf_dir, "documents")))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(read(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_preference": op1_preference,
    "op2_token_ids": op2_token_ids,
    "op3_warc": op3_warc,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_secrets": op6_secrets,
    "op7_host_rules": op7_host_rules,
    "op8_decontaminate": op8_decontaminate,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_simhash": op10_simhash,
}

ORACLE_SQL: dict[str, str] = {
    "op1_preference": preference.oracle(),
    "op7_host_rules": rules.oracle(),
    "op8_decontaminate": decontaminate.oracle(),
}
