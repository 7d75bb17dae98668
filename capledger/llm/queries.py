"""The registered queries of this package, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    align, bit_codes, bpe, fill_middle, grid_join, licenses, minhash, mixing, oracles, quality, secrets, token_counts,
    url_filter, warc,
)
from .common import documents


#: Production weights. Sources are grouped into three domains; 90 % of the tokens are kept, each at most once.
MIXTURE = mixing.Settings(
    domains={
        **{f"src{i}": "web" for i in range(10)}, **{f"src{i}": "books" for i in range(10, 15)},
        **{f"src{i}": "forums" for i in range(15, 20)},
    },
    domain_weights={"web": 0.5, "books": 0.3, "forums": 0.2, "other": 0.1},
    language_weights={"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15}, other_language_weight=0.05, other_domain_weight=0.1,
    share=0.9, max_epochs=1, seed=17,
)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op2_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_codes.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda vec_id: vec_id % 20 == 0)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), MIXTURE)


def op4_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), minhash.Settings(words=2))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digests(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(documents(spark, sf_dir))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.over_limit(documents(spark, sf_dir))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digests(documents(spark, sf_dir))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(documents(spark, sf_dir))


def license_base_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the licence scan finds of the phrases that are fixed, without the labels of its own."""
    return licenses.digests(documents(spark, sf_dir)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many secrets of the fixed kinds the scan finds."""
    return secrets.digests(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe, op2_bit_codes, op3_mixing, op4_grid_join, op5_minhash, op6_warc, op7_licenses, op8_quality, op9_url_filter,
        op10_secrets, op11_token_counts, op12_align, op13_fill_middle, license_base_places, secret_base_counts,
    )
}

ORACLES: dict[str, str] = {
    "op4_grid_join": oracles.GRID_JOIN, "op5_minhash": oracles.MINHASH, "op6_warc": oracles.WARC, "op9_url_filter": oracles.URL_FILTER,
    "op13_fill_middle": fill_middle.DIGESTS_SQL, "license_base_places": oracles.LICENSE_BASE, "secret_base_counts": oracles.SECRET_BASE,
}
