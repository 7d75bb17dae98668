"""Statistics over the stored tables and the flattened export rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from capledger.functions.text import joined, text_or_empty
from capledger.operators.rounds import non_duplicates

EXACT_MONEY = "decimal(38,2)"


def total_amount(amount: str = "amount_raised_usd") -> Column:
    return F.coalesce(F.sum(amount), F.lit(0.0))


def rounds_by_source(rounds: DataFrame) -> DataFrame:
    return non_duplicates(rounds).groupBy("source_type").agg(F.count("*").alias("rounds"))


def total_amount_raised(rounds: DataFrame) -> DataFrame:
    return non_duplicates(rounds).agg(total_amount().alias("total_amount_raised_usd"))


def statistics(
    companies: DataFrame, rounds: DataFrame, investors: DataFrame, sources: DataFrame
) -> DataFrame:
    """One row of table counts and the amount raised; each table is read once."""
    unique = ~F.col("is_duplicate")
    counted = rounds.agg(
        F.count_if(unique).alias("funding_rounds"),
        F.count("*").alias("total_rounds_including_duplicates"),
        F.count_if(F.col("is_duplicate")).alias("duplicates_found"),
        F.coalesce(
            F.sum(F.when(unique, F.col("amount_raised_usd"))), F.lit(0.0)
        ).alias("total_amount_raised_usd"),
    ).withColumn("one", F.lit(1))
    result = counted
    for name, table in (("companies", companies), ("investors", investors), ("sources", sources)):
        count = table.agg(F.count("*").alias(name)).withColumn("one", F.lit(1))
        result = result.join(count, "one")
    return result.select(
        "companies", "funding_rounds", "total_rounds_including_duplicates", "investors", "sources",
        "duplicates_found", "total_amount_raised_usd",
    )


def investor_names(round_investors: DataFrame, investors: DataFrame) -> DataFrame:
    """(round_id, investors): names in order of investor id, joined by comma and space.

    A round's text is one value of the result and holds each of its investors once.
    """
    names = investors.select(F.col("id").alias("investor_id"), "name")
    # Repeated links fall together in the set: they need no shuffle of their own.
    ordered = F.array_sort(F.collect_set(F.struct("investor_id", "name")))
    return (
        round_investors.join(names, "investor_id").groupBy("round_id")
        .agg(F.array_join(F.transform(ordered, lambda i: i["name"]), ", ").alias("investors"))
    )


def export_rows(
    rounds: DataFrame, companies: DataFrame, round_investors: DataFrame, investors: DataFrame
) -> DataFrame:
    """The 13 export columns of all rounds that are not duplicates."""
    owners = companies.select(F.col("id").alias("company_id"), "name", "cik")
    names = investor_names(round_investors, investors).withColumnRenamed("round_id", "id")
    return (
        non_duplicates(rounds).join(owners, "company_id").join(names, "id", "left")
        .select(
            F.col("name").alias("Company Name"),
            text_or_empty(F.col("cik")).alias("Company CIK"),
            text_or_empty(F.col("round_name")).alias("Round Name"),
            text_or_empty(F.col("date")).alias("Date"),
            F.col("amount_raised_usd").alias("Amount Raised (USD)"),
            F.col("pre_money_valuation_usd").alias("Pre-Money Valuation (USD)"),
            F.col("post_money_valuation_usd").alias("Post-Money Valuation (USD)"),
            text_or_empty(F.col("lead_investor")).alias("Lead Investor"),
            text_or_empty(F.col("investors")).alias("All Investors"),
            F.col("source_type").alias("Source Type"),
            F.col("confidence_score").alias("Confidence Score"),
            joined(F.col("source_urls")).alias("Source URLs"),
            text_or_empty(F.col("notes")).alias("Notes"),
        )
    )
