"""From documents to token ids: the stages of the training-data pipeline, in order.

Each stage takes all documents its predecessor kept. The first four return documents with
the columns they came with; the last returns doc_id, ids, n_tokens and the digests of ids
and decoded bytes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, language_id, minhash, mixing, quality_rules
from millrace.llm.queries import MIX, RANKS, WORD_COUNT, with_domain
from millrace.storage import new_dir

# Every document is used once at most, so that mixing repeats none.
PIPELINE_MIX = mixing.Mix(MIX.levels, MIX.weights, budget_percent=80, max_epochs=1, seed=MIX.seed)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a language that the labelled ones teach; the others go."""
    train = docs.select(F.col("doc_id").alias("id"), "text", "lang")
    return language_id.known_language(docs, train)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the rules learned from the labels."""
    return quality_rules.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return minhash.one_of_each(docs, minhash.Settings(shingle=5, percent=80, trees=32))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the budgets of domain, language and source take."""
    sized = with_domain(docs.select("doc_id", "lang", "source", F.struct(*docs.columns).alias("whole")))
    sized = sized.withColumn("n_tokens", F.expr(WORD_COUNT.replace("text", "whole.text")).cast("long"))
    return mixing.mix(sized, PIPELINE_MIX).select("whole.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    pattern = public_tokenizers.PATTERN
    encoded = byte_bpe.encode(docs.select("doc_id", "text"), RANKS, pattern)
    return byte_bpe.digests(byte_bpe.decode(encoded, RANKS, pattern), keep_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("minhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# The stages learn, sign and encode; SQL cannot express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table.

    What a stage keeps is written below the shared folder and read again by the next one, so
    no stage runs twice, whatever reads its rows or is lost after it.
    """
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), new_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs
