"""Queries over the call log."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from capledger.checks import shapes
from capledger.checks.registry import query
from capledger.checks.shapes import sql
from capledger.operators import usage

DAILY_SQL = """
    SELECT provider_name, model_name, strftime(ts, '%Y-%m-%d') AS date, count(*) AS total_calls,
           count(*) FILTER (success) AS successful_calls, count(*) FILTER (NOT success) AS failed_calls,
           count(*) FILTER (rate_limited) AS rate_limited_calls,
           CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens,
           CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens,
           round(avg(latency_ms), 9) AS average_latency_ms, min(latency_ms) AS min_latency_ms,
           max(latency_ms) AS max_latency_ms
    FROM t_calls GROUP BY ALL"""


@query(sql(DAILY_SQL))
def daily_usage(spark, root):
    daily = usage.daily_usage(shapes.calls(spark, root))
    return daily.withColumn("average_latency_ms", F.round("average_latency_ms", 9))


@query(sql(f"SELECT provider_name, model_name, date, total_calls FROM ({DAILY_SQL}) WHERE provider_name = 'click'"))
def usage_of_provider(spark, root):
    stats = usage.usage_stats(usage.daily_usage(shapes.calls(spark, root)), "click")
    return stats.select("provider_name", "model_name", "date", "total_calls")


_STATS_SQL = """
    SELECT name, count(event_id) AS total_calls, count(*) FILTER (success) AS successful_calls,
           count(*) FILTER (NOT success) AS failed_calls, count(*) FILTER (rate_limited) AS rate_limited_calls,
           round(100.0 * count(*) FILTER (success) / count(event_id), 6) AS success_rate,
           round(coalesce(avg(latency_ms) FILTER (success), 0), 9) AS average_latency_ms,
           enabled, has_api_key
    FROM t_providers LEFT JOIN t_calls ON name = provider_name GROUP BY name, enabled, has_api_key"""


@query(sql(_STATS_SQL))
def provider_statistics(spark, root):
    stats = usage.provider_stats(shapes.providers(spark, root), shapes.calls(spark, root))
    return stats.withColumn("success_rate", F.round("success_rate", 6)).withColumn(
        "average_latency_ms", F.round("average_latency_ms", 9)
    )


@query(sql(f"""
    SELECT 'priority' AS rotation_strategy, count(*) AS total_providers,
           count(*) FILTER (enabled AND has_api_key) AS active_providers,
           string_agg(name || '=' || total_calls, ', ' ORDER BY name) AS providers
    FROM ({_STATS_SQL})"""))
def router_summary(spark, root):
    summary = usage.router_summary(shapes.providers(spark, root), shapes.calls(spark, root), "priority")
    listed = F.transform("providers", lambda p: F.concat(p["name"], F.lit("="), p["total_calls"].cast("string")))
    return summary.withColumn("providers", F.array_join(listed, ", "))


@query(sql("""
    SELECT name, priority, rate_limit_rpm, count(*) AS total_calls FROM t_providers JOIN t_calls ON name = provider_name
    WHERE enabled AND has_api_key GROUP BY name, priority, rate_limit_rpm"""))
def least_used_providers(spark, root):
    least = usage.least_used(shapes.providers(spark, root), shapes.calls(spark, root))
    return least.select("name", "priority", "rate_limit_rpm", "total_calls")


@query(sql("SELECT account, count(*) AS calls_made FROM t_calls GROUP BY account"))
def calls_per_account(spark, root):
    return usage.calls_per_account(shapes.calls(spark, root), "account")


@query(sql("""
    SELECT event_id, position, p.name AS provider_name
    FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position FROM t_calls) c
    JOIN (SELECT name, row_number() OVER (ORDER BY priority, name) AS turn, count(*) OVER () AS size
          FROM t_providers WHERE enabled AND has_api_key) p ON (position - 1) % size + 1 = turn"""))
def round_robin_assignment(spark, root):
    requests = shapes.calls(spark, root).select("event_id", "ts")
    assigned = usage.round_robin(requests, shapes.providers(spark, root), ["ts", "event_id"])
    return assigned.select("event_id", "position", "provider_name")


@query(sql("""
    SELECT event_id, (position - 1) // size AS minute, p.name AS provider_name
    FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position FROM t_calls) c
    JOIN (SELECT name, rate_limit_rpm, sum(rate_limit_rpm) OVER (ORDER BY priority, name) AS upto,
                 CAST(sum(rate_limit_rpm) OVER () AS BIGINT) AS size
          FROM t_providers WHERE enabled AND has_api_key) p
      ON (position - 1) % size >= upto - rate_limit_rpm AND (position - 1) % size < upto"""))
def priority_assignment(spark, root):
    requests = shapes.calls(spark, root).select("event_id", "ts")
    filled = usage.priority_fill(requests, shapes.providers(spark, root), ["ts", "event_id"])
    return filled.select("event_id", "minute", "provider_name")


@query(sql("""
    SELECT event_id, account, gap_micros FROM (
      SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY account ORDER BY ts, event_id) AS gap_micros
      FROM t_calls) WHERE gap_micros < 3600000000"""))
def close_calls(spark, root):
    calls = shapes.calls(spark, root).select("event_id", "account", "ts")
    return usage.close_calls(calls, "account", 3600).drop("ts")


QUOTA_SQL = """
    SELECT provider_name, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*) AS calls,
           CAST(1 AS INT) AS limit_rpm
    FROM t_calls GROUP BY ALL HAVING count(*) > 1"""


def tight_limits(spark, root):
    """Providers allowed a single call a minute, so that breaches occur."""
    return shapes.providers(spark, root).withColumn("rate_limit_rpm", F.lit(1))


@query(sql(QUOTA_SQL))
def quota_breaches(spark, root):
    found = usage.quota_breaches(shapes.calls(spark, root), tight_limits(spark, root))
    return found.select(
        F.col("name").alias("provider_name"), F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"),
        "calls", F.col("rate_limit_rpm").alias("limit_rpm"),
    )


def _in_order(df, *columns):
    """The rows with their place in the order they come in."""
    placed = df.select(*columns, F.monotonically_increasing_id().alias("at"))
    return placed.select(*columns, F.row_number().over(Window.orderBy("at")).alias("place"))


@query(sql(f"""
    SELECT provider_name, model_name, date, row_number() OVER (ORDER BY date DESC, provider_name, model_name) AS place FROM ({DAILY_SQL})"""))
def usage_newest_first(spark, root):
    """The order of the usage listing, not only its rows."""
    return _in_order(usage.usage_stats(usage.daily_usage(shapes.calls(spark, root))), "provider_name", "model_name", "date")


@query(sql("""
    SELECT name, row_number() OVER (ORDER BY n, priority, name) AS place FROM (
      SELECT name, priority, count(event_id) AS n FROM t_providers LEFT JOIN t_calls ON name = provider_name
      WHERE enabled AND has_api_key GROUP BY name, priority)"""))
def least_used_first(spark, root):
    return _in_order(usage.least_used(shapes.providers(spark, root), shapes.calls(spark, root)), "name")
