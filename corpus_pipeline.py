"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of ``documents``. ``run`` writes each
stage's rows as Parquet below the cluster's shared folder and reads them again.
A stage whose rows go to Python leaves the session with Arrow batches of at most
BATCH_ROWS rows, for its rows are computed later; ``run`` sets back what it found.

* quality: documents that the line classifier scores below 0.3 go. It learns
  from the labelled rows among ``docs``, as its own query does.
* dedup: of each group of near-duplicates one row stays: that of the smallest id,
  or one without an id if none has any. Texts are linked whose sets of five-word
  shingles have a Jaccard similarity of 0.8 or more, every such pair and no other:
  trees over their SimHash fingerprints find the near ones, prefixes the rest.
* decontaminate: documents that hold 0.8 or more of a benchmark item's five-word
  shingles go.
* secrets: every secret found is replaced by <secret>; documents stay, and
  n_chars follows the text.
* tokens: ids of each text by byte-level BPE, and how many bytes they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard, quality, secrets
from tidemark.llm.common import keyed, read, release, scratch, ship


#: Jaccard similarity from which texts are near-duplicates.
SIMILARITY = 0.8
#: Rows that a Python worker is sent at once: some 4 MB of documents.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000


def small_batches(spark: SparkSession) -> None:
    """Send Python workers BATCH_ROWS rows at once at most: each task holds a batch on both sides."""
    given = int(spark.conf.get(BATCH_SETTING))
    spark.conf.set(BATCH_SETTING, min(BATCH_ROWS, given) if given > 0 else BATCH_ROWS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts."""
    small_batches(spark)
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.good(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id.

    Rows are told apart by a key, so of rows that repeat an id one stays, and
    rows without an id go as well where they are copies.
    """
    ship(spark)
    small_batches(spark)
    rows, key = keyed(docs)
    found = jaccard.near_duplicates(rows, id_col=key, size=5, threshold=SIMILARITY)
    groups = rows.select(key, "doc_id").join(found, key)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("row")))
    kept = groups.groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias(key))
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their secrets masked."""
    ship(spark)
    small_batches(spark)
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>), and n_bytes: the bytes that the ids decode to."""
    ship(spark)
    small_batches(spark)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.checked(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_good),
    ("dedup", keep_one_of_each),
    ("decontaminate", drop_leaks),
    ("secrets", mask_secrets),
    ("tokens", to_tokens),
]

#: A trained classifier and a tokenizer are among the stages: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What a stage held is let go before the next one starts.
    """
    given = spark.conf.get(BATCH_SETTING)
    try:
        docs = read(spark, sf_dir, "documents")
        for name, stage in STAGES:
            at = scratch(spark, f"stage-{name}")
            stage(spark, docs, sf_dir).write.parquet(at)
            docs = spark.read.parquet(at)
            release(spark)
        return docs
    finally:
        spark.conf.set(BATCH_SETTING, given)
