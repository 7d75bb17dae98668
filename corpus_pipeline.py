"""A corpus pipeline of five stages over ``documents``.

Low-quality documents go, one document of each group of near-duplicates stays, secrets are masked, sources
are mixed to target weights, and what is left is encoded. Each stage is written as Parquet and read again
before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capledger.llm import bpe, minhash, mixing, quality, secrets
from capledger.llm.common import shared_table, short_batches
from capledger.llm.queries import MIXTURE

def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    short_batches(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def without_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, a similarity of 0.8 or more."""
    short_batches(spark)
    return minhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind."""
    short_batches(spark)
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the budgets of domains, languages and sources leave room for."""
    short_batches(spark)
    return mixing.mix(docs, MIXTURE)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and digests of the ids and of the text they decode to."""
    short_batches(spark)
    return bpe.digests(docs, None, "ids")


STAGES = [
    ("quality classifier", good_quality), ("MinHash near-dedup", without_duplicates), ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed), ("BPE encoding and decoding", encoded),
]

#: Compression and token merging cannot be said in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = shared_table(docs, f"stage-{number}")
    return docs
