"""Get-or-create of companies and investors by natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from capledger.functions.text import strip, text_or_null
from capledger.session import sized


def key_of(*columns: str | Column) -> Column:
    """A stable non-negative id from a natural key."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 63) - 1))


def company_by_name(companies: DataFrame, name: str) -> DataFrame:
    """The company of exactly this name; at most one row."""
    return companies.where(F.col("name") == name).limit(1)


def upsert_companies(existing: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """All companies after taking in ``incoming`` (name, cik, official_name).

    Unknown names become new rows. Known ones keep what they have; an empty cik or official
    name is filled from the incoming row. Several incoming rows of one name count as one, with
    the smallest non-empty values.
    """
    new = incoming.groupBy(F.col("name").alias("new_name")).agg(
        F.min(text_or_null(F.col("cik"))).alias("new_cik"),
        F.min(text_or_null(F.col("official_name"))).alias("new_official_name"),
    )
    known = F.col("id").isNotNull()

    def filled(column: str) -> Column:
        return F.coalesce(text_or_null(F.col(column)), F.col(f"new_{column}"))

    changed = known & (
        (filled("cik").isNotNull() & text_or_null(F.col("cik")).isNull())
        | (filled("official_name").isNotNull() & text_or_null(F.col("official_name")).isNull())
    )
    return existing.join(new, existing["name"] == new["new_name"], "full_outer").select(
        F.when(known, F.col("id")).otherwise(key_of("new_name")).alias("id"),
        F.coalesce("name", "new_name").alias("name"),
        filled("cik").alias("cik"),
        filled("official_name").alias("official_name"),
        F.when(known, F.col("created_at")).otherwise(now).alias("created_at"),
        F.when(known & ~changed, F.col("updated_at")).otherwise(now).alias("updated_at"),
    )


def new_names(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Distinct incoming names that are not known yet."""
    return incoming.select("name").distinct().join(sized(known.select("name")), "name", "left_anti")


def exploded_investors(rounds: DataFrame) -> DataFrame:
    """(round_id, name): stripped investor names of each round, blank ones dropped."""
    return (
        rounds.select(F.col("id").alias("round_id"), F.explode("all_investors").alias("raw_name"))
        .select("round_id", strip(F.col("raw_name")).alias("name"))
        .where(F.col("name") != "")
    )


def created_investors(existing: DataFrame, named: DataFrame, now: Column) -> DataFrame:
    """Rows of the investors in ``named`` that are not known yet."""
    return new_names(existing, named).select(
        key_of("name").alias("id"), "name",
        F.lit(None).cast("string").alias("investor_type"),
        now.alias("created_at"), now.alias("updated_at"),
    )


def upsert_investors(existing: DataFrame, named: DataFrame, now: Column) -> DataFrame:
    """All investors after taking in the names of ``named``; known ones are left alone."""
    return existing.unionByName(created_investors(existing, named, now))


def investor_links(named: DataFrame, investors: DataFrame) -> DataFrame:
    """Distinct (round_id, investor_id) pairs of ``exploded_investors`` rows."""
    ids = investors.select(F.col("id").alias("investor_id"), "name")
    return named.distinct().join(ids, "name").select("round_id", "investor_id")
