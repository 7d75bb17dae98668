"""Usage and quota figures over a stream of model calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from capledger.operators.usage import usage_aggregates


def daily_usage_stream(calls: DataFrame) -> DataFrame:
    """Usage per provider, model and day; in update mode a row replaces its earlier versions.

    There is no watermark: a call counts however late it comes. The state has a row per result row.
    """
    return (
        calls.groupBy("provider_name", "model_name", F.window("ts", "1 day").alias("day"))
        .agg(*usage_aggregates())
        .withColumn("date", F.date_format("day.start", "yyyy-MM-dd"))
        .drop("day")
    )


def minute_calls_stream(calls: DataFrame) -> DataFrame:
    """Calls per provider and clock minute, late ones included."""
    return (
        calls.groupBy("provider_name", F.window("ts", "1 minute").alias("span"))
        .agg(F.count("*").alias("calls"))
        .select("provider_name", F.col("span.start").alias("minute"), "calls")
    )


def quota_breaches_stream(calls: DataFrame, providers: DataFrame) -> DataFrame:
    """Provider minutes with more calls than the limit (stream-static join)."""
    limits = providers.select(F.col("name").alias("provider_name"), "rate_limit_rpm")
    return minute_calls_stream(calls).join(limits, "provider_name").where(
        F.col("calls") > F.col("rate_limit_rpm")
    )


def write_versions(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain a stream in update mode into a table of row versions (column ``version``).

    A batch that is run again after a failure overwrites its own folder, so every version is
    there once.
    """
    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(_version_writer(path))
        .start()
    )


def _version_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return write


def latest_versions(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of every key."""
    rest = [c for c in versions.columns if c not in keys and c != "version"]
    newest = F.max_by(F.struct(*rest), "version").alias("_newest")
    return versions.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
