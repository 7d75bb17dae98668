"""Model-call logs: daily usage, provider statistics, call limits and work assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from capledger.functions.dates import utc_day
from capledger.functions.numbers import percent
from capledger.operators.ranking import global_rank


def usage_aggregates() -> list[Column]:
    """The measures of one usage row, as aggregates over calls."""
    return [
        F.count("*").alias("total_calls"),
        F.count_if(F.col("success")).alias("successful_calls"),
        F.count_if(~F.col("success")).alias("failed_calls"),
        F.count_if(F.col("rate_limited")).alias("rate_limited_calls"),
        F.sum("input_tokens").alias("total_input_tokens"),
        F.sum("output_tokens").alias("total_output_tokens"),
        F.avg("latency_ms").alias("average_latency_ms"),
        F.min("latency_ms").alias("min_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
    ]


def daily_usage(calls: DataFrame) -> DataFrame:
    """Usage per provider, model and UTC day."""
    day = utc_day(F.col("ts")).alias("date")
    return calls.groupBy("provider_name", "model_name", day).agg(*usage_aggregates())


def usage_stats(usage: DataFrame, provider_name: str | None = None) -> DataFrame:
    """Usage rows, newest day first; of one provider if given."""
    chosen = usage.where(F.col("provider_name") == provider_name) if provider_name else usage
    return chosen.orderBy(F.desc("date"), "provider_name", "model_name")


def provider_stats(providers: DataFrame, calls: DataFrame) -> DataFrame:
    """Lifetime figures of every provider, also of those never called.

    The mean latency is over successful calls only.
    """
    used = calls.groupBy(F.col("provider_name").alias("name")).agg(
        F.count("*").alias("total_calls"),
        F.count_if(F.col("success")).alias("successful_calls"),
        F.count_if(~F.col("success")).alias("failed_calls"),
        F.count_if(F.col("rate_limited")).alias("rate_limited_calls"),
        F.avg(F.when(F.col("success"), F.col("latency_ms"))).alias("mean_latency"),
    )
    counters = ["total_calls", "successful_calls", "failed_calls", "rate_limited_calls"]
    return providers.join(used, "name", "left").fillna(0, counters).select(
        "name", *counters,
        percent(F.col("successful_calls"), F.col("total_calls")).alias("success_rate"),
        F.coalesce("mean_latency", F.lit(0.0)).alias("average_latency_ms"),
        "enabled", "has_api_key",
    )


def active_providers(providers: DataFrame) -> DataFrame:
    return providers.where(F.col("enabled") & F.col("has_api_key"))


def router_summary(providers: DataFrame, calls: DataFrame, strategy: str) -> DataFrame:
    """One row: strategy, provider counts and the statistics of all providers, by name."""
    stats = provider_stats(providers, calls)
    return stats.agg(
        F.lit(strategy).alias("rotation_strategy"),
        F.count("*").alias("total_providers"),
        F.count_if(F.col("enabled") & F.col("has_api_key")).alias("active_providers"),
        F.array_sort(F.collect_list(F.struct(*stats.columns))).alias("providers"),
    )


def least_used(providers: DataFrame, calls: DataFrame) -> DataFrame:
    """Active providers, least used first; ties in priority order."""
    counts = calls.groupBy(F.col("provider_name").alias("name")).agg(F.count("*").alias("total_calls"))
    return (
        active_providers(providers).join(counts, "name", "left").fillna(0, ["total_calls"])
        .orderBy("total_calls", "priority", "name")
    )


def calls_per_account(calls: DataFrame, account: str) -> DataFrame:
    return calls.groupBy(account).agg(F.count("*").alias("calls_made"))


def round_robin(requests: DataFrame, providers: DataFrame, order: list[str]) -> DataFrame:
    """Requests in ``order``, each with the next active provider in turn (by priority)."""
    turns = active_providers(providers).select(
        F.row_number().over(Window.orderBy("priority", "name")).alias("turn"), F.col("name").alias("provider_name")
    )
    size = turns.agg(F.count("*")).scalar()
    ranked = global_rank(requests, order).withColumn("size", size)
    return (
        ranked.withColumn("turn", F.pmod(F.col("position") - 1, F.col("size")).cast("int") + 1)
        .join(turns, "turn").drop("turn", "size")
    )


def priority_fill(requests: DataFrame, providers: DataFrame, order: list[str]) -> DataFrame:
    """Requests in ``order``, filling each minute's quotas by priority.

    Every provider takes ``rate_limit_rpm`` requests a minute; when all are full the next
    minute starts. Adds ``minute`` (from 0) and ``provider_name``.
    """
    by_priority = Window.orderBy("priority", "name")
    quotas = active_providers(providers).where(F.col("rate_limit_rpm") > 0).select(
        F.col("name").alias("provider_name"),
        F.sum("rate_limit_rpm").over(by_priority).alias("upto"),
        "rate_limit_rpm",
    )
    per_minute = quotas.agg(F.sum("rate_limit_rpm")).scalar()
    # A slot per unit of quota, so that finding the provider of a slot is an equi-join.
    slots = quotas.select(
        "provider_name",
        F.explode(F.sequence(F.col("upto") - F.col("rate_limit_rpm"), F.col("upto") - 1)).alias("slot"),
    )
    ranked = global_rank(requests, order).withColumn("per_minute", per_minute)
    return (
        ranked.withColumn("minute", F.floor((F.col("position") - 1) / F.col("per_minute")))
        .withColumn("slot", F.pmod(F.col("position") - 1, F.col("per_minute")))
        .join(slots, "slot").drop("slot", "per_minute")
    )


def close_calls(calls: DataFrame, account: str, min_gap_seconds: float) -> DataFrame:
    """Calls made less than ``min_gap_seconds`` after the previous call of the account.

    Time is cut into slots as long as the gap: the previous call is in the same slot or it is
    the last one of the slot before, so no window spans an account's whole history.
    """
    gap = round(min_gap_seconds * 1_000_000)
    micros = F.unix_micros("ts")
    slotted = calls.withColumn("at", micros).withColumn("slot", F.floor(micros / gap))
    last_of_slot = slotted.groupBy(account, (F.col("slot") + 1).alias("slot")).agg(
        F.max("at").alias("before_slot")
    )
    in_slot = Window.partitionBy(account, "slot").orderBy("at", *_tie_breakers(calls, account))
    previous = F.coalesce(F.lag("at").over(in_slot), F.col("before_slot"))
    return (
        slotted.join(last_of_slot, [account, "slot"], "left")
        .withColumn("gap_micros", F.col("at") - previous)
        .where(F.col("gap_micros") < gap)
        .select(*calls.columns, "gap_micros")
    )


def _tie_breakers(calls: DataFrame, account: str) -> list[str]:
    return [c for c in calls.columns if c not in (account, "ts")]


def quota_breaches(calls: DataFrame, providers: DataFrame) -> DataFrame:
    """Provider minutes (clock-aligned) with more calls than the provider's limit."""
    minutes = calls.groupBy(
        F.col("provider_name").alias("name"), F.date_trunc("minute", "ts").alias("minute")
    ).agg(F.count("*").alias("calls"))
    limits = providers.select("name", "rate_limit_rpm")
    return minutes.join(limits, "name").where(F.col("calls") > F.col("rate_limit_rpm"))
