"""Queries that write and read back: sinks, the CSV source, and streams drained to the end."""

from __future__ import annotations

import datetime as dt
import math
import uuid
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from capledger.checks import shapes
from capledger.checks.registry import query
from capledger.checks.shapes import sql
from capledger.checks.tables import EXPORT_SQL, export_frame
from capledger.checks.usage import DAILY_SQL, QUOTA_SQL, tight_limits
from capledger.options import ExportOptions
from capledger.plans import export
from capledger.session import checkpoint_root
from capledger.sources.company_list import read_company_list
from capledger.streaming import rounds as round_stream, usage as usage_stream


def workspace(spark) -> str:
    """A new folder next to the checkpoints, where every executor can write."""
    return f"{checkpoint_root(spark).rstrip('/')}/capledger-{uuid.uuid4().hex}"


@query(sql(f"""
    SELECT "Company Name", nullif("Company CIK", '') AS "Company CIK", "Round Name", nullif("Date", '') AS "Date",
           "Amount Raised (USD)", "Pre-Money Valuation (USD)", nullif("All Investors", '') AS "All Investors",
           "Source URLs", nullif("Notes", '') AS "Notes" FROM ({EXPORT_SQL})"""))
def csv_export(spark, root):
    path = f"{workspace(spark)}/rounds.csv"
    export.write_csv(export_frame(spark, root), path)
    back = spark.read.csv(path, header=True, escape='"')
    return back.select(
        "Company Name", "Company CIK", "Round Name", "Date",
        F.col("Amount Raised (USD)").cast("double"), F.col("Pre-Money Valuation (USD)").cast("double"),
        "All Investors", "Source URLs", "Notes",
    )


@query(sql(EXPORT_SQL))
def json_export(spark, root):
    path = f"{workspace(spark)}/rounds.json"
    rows = export_frame(spark, root)
    export.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query(sql(EXPORT_SQL))
def sheet_export(spark, root):
    path = f"{workspace(spark)}/rounds.parquet"
    export.write_sheet(export_frame(spark, root), path)
    return spark.read.parquet(path)


@query(sql(f"""
    SELECT format, "Company Name", "Round Name", "Source URLs", "Amount Raised (USD)" AS amount, named_after AS named
    FROM ({EXPORT_SQL}), (VALUES ('excel', 'rounds_20240506_070809.parquet'), ('csv', 'rounds_20240506_070809.csv'),
      ('json', 'rounds_20240506_070809.json'), ('nothing', 'none, none, none')) AS f(format, named_after)
    WHERE format <> 'nothing' UNION ALL SELECT 'nothing', NULL, NULL, NULL, NULL, 'none, none, none'"""))
def all_export_formats(spark, root):
    """Every format from one evaluation, named after its time, and read back; nothing is written for no rows."""
    rows = export_frame(spark, root)
    options = ExportOptions(output_directory=workspace(spark), filename_template="rounds_{timestamp}")
    at = dt.datetime(2024, 5, 6, 7, 8, 9)
    written = export.export_all(rows, options, at)
    nothing = export.export_all(rows.where(F.lit(False)), options, at)
    back = {
        "excel": spark.read.parquet(written["excel"]), "csv": spark.read.csv(written["csv"], header=True, escape='"'),
        "json": spark.read.schema(rows.schema).json(written["json"]),
    }
    parts = [
        df.select(
            F.lit(name).alias("format"), "Company Name", "Round Name", "Source URLs", F.col("Amount Raised (USD)").cast("double").alias("amount"),
            F.lit(written[name].rsplit("/", 1)[-1]).alias("named"),
        )
        for name, df in back.items()
    ]
    told = ", ".join("none" if nothing[f] is None else nothing[f] for f in ("excel", "csv", "json"))
    # one row that tells what an empty export wrote
    parts.append(rows.limit(1).select(
        F.lit("nothing").alias("format"), *[F.lit(None).cast("string").alias(c) for c in ("Company Name", "Round Name", "Source URLs")],
        F.lit(None).cast("double").alias("amount"), F.lit(told).alias("named"),
    ))
    return reduce(DataFrame.unionByName, parts)


@query("""
    SELECT name FROM (SELECT trim(c_name) AS name, row_number() OVER (ORDER BY c_custkey DESC) AS place FROM customer) WHERE place <= 37""")
def first_listed_companies(spark, root):
    """The first names of a list in the order of its file, which is not that of the names."""
    path = f"{workspace(spark)}/companies.csv"
    shapes.companies(spark, root).orderBy(F.desc("id")).coalesce(1).select(F.col("name").alias("Companies")).write.csv(path, header=True)
    return read_company_list(spark, path, limit=37)


@query("SELECT trim(c_name) AS name FROM customer WHERE c_name <> ''")
def company_list(spark, root):
    path = f"{workspace(spark)}/companies.csv"
    shapes.companies(spark, root).select(
        F.concat(F.lit(" "), F.col("name")).alias("company"), F.lit(None).cast("string").alias("Other")
    ).write.csv(path, header=True, ignoreLeadingWhiteSpace=False)
    return read_company_list(spark, path)


@query(sql(DAILY_SQL))
def daily_usage_stream(spark, root):
    base = workspace(spark)
    stream = usage_stream.daily_usage_stream(shapes.call_stream(spark, root))
    usage_stream.write_versions(stream, f"{base}/usage", f"{base}/checkpoint").awaitTermination()
    latest = usage_stream.latest_versions(
        spark.read.parquet(f"{base}/usage"), ["provider_name", "model_name", "date"]
    )
    return latest.withColumn("average_latency_ms", F.round("average_latency_ms", 9))


@query(sql(QUOTA_SQL))
def quota_breaches_stream(spark, root):
    base = workspace(spark)
    stream = usage_stream.quota_breaches_stream(shapes.call_stream(spark, root), tight_limits(spark, root))
    usage_stream.write_versions(stream, f"{base}/quota", f"{base}/checkpoint").awaitTermination()
    latest = usage_stream.latest_versions(spark.read.parquet(f"{base}/quota"), ["provider_name", "minute"])
    return latest.select(
        "provider_name", F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "calls",
        F.col("rate_limit_rpm").alias("limit_rpm"),
    )


#: A landed file holds about as many rows at most; larger batches consist of several files.
ROWS_PER_FILE = 250_000


def landed_stream(rows: DataFrame, path: str, batches: int, *order) -> DataFrame:
    """Rows landed as files by ranges of an order, and read as a stream of a number of batches."""
    files = max(1, math.ceil(rows.count() / (batches * ROWS_PER_FILE)))
    rows.repartitionByRange(batches * files, *order).write.parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def arriving_rounds(spark, root, base):
    """The rounds as a stream of landed files."""
    rounds = shapes.rounds(spark, root).withColumn("source_url", F.get("source_urls", F.lit(0)))
    return landed_stream(rounds, f"{base}/landed", 2, "created_at")


@query(sql("SELECT id, company_id, winner_id FROM t_rounds LEFT JOIN t_losers ON id = round_id"))
def merge_stream(spark, root):
    base = workspace(spark)
    arrivals = arriving_rounds(spark, root, base).drop("source_url")
    round_stream.merge_stream(arrivals, f"{base}/store", f"{base}/checkpoint").awaitTermination()
    return round_stream.merge_store(spark, f"{base}/store").read("marks")


@query(sql("SELECT id, company_id, date FROM t_rounds"))
def first_arrivals_stream(spark, root):
    """Every round lands twice, newest days first and in several batches; one arrival of each is kept."""
    base = workspace(spark)
    rounds = shapes.rounds(spark, root)
    arrivals = landed_stream(rounds.unionByName(rounds), f"{base}/landed", 4, F.desc("created_at"), F.rand(1))
    kept = round_stream.first_arrivals(arrivals)
    (
        kept.select("id", "company_id", "date").writeStream.format("parquet")
        .option("path", f"{base}/kept").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(f"{base}/kept")


@query(sql("""
    SELECT DISTINCT company_id, source_type, round_name, date, amount_raised_usd, pre_money_valuation_usd, source_urls
    FROM t_rounds"""))
def recollected_arrivals_stream(spark, root):
    """A later run lands every round again, under another id and time; each content is kept once."""
    base = workspace(spark)
    rounds = shapes.rounds(spark, root)
    later = rounds.withColumn("id", -F.col("id")).withColumn("created_at", F.expr("created_at + INTERVAL 40 YEARS"))
    arrivals = landed_stream(rounds.unionByName(later), f"{base}/landed", 4, "created_at", F.rand(1))
    (
        round_stream.first_arrivals(arrivals, round_stream.CONTENT).writeStream.format("parquet")
        .option("path", f"{base}/kept").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(f"{base}/kept").select(
        "company_id", "source_type", "round_name", "date", "amount_raised_usd", "pre_money_valuation_usd",
        F.array_join("source_urls", ", ").alias("source_urls"),
    )


@query(sql(DAILY_SQL))
def resumed_usage_stream(spark, root):
    """The stream breaks in its third batch, after the state was updated; a second run goes on from its checkpoint."""
    base = workspace(spark)
    events = shapes.table(spark, root, "events")
    source = landed_stream(events, f"{base}/landed", 5, "ts")

    def calls():
        return usage_stream.daily_usage_stream(source.selectExpr(*shapes.CALL_COLUMNS))

    def breaking(batch, batch_id):
        if batch_id == 2:
            raise RuntimeError("stopped on purpose")
        batch.write.mode("overwrite").parquet(f"{base}/usage/version={batch_id}")

    broken = calls().writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
    try:
        broken.foreachBatch(breaking).start().awaitTermination()
    except StreamingQueryException:
        pass
    else:
        raise AssertionError("the first run should have been stopped")
    usage_stream.write_versions(calls(), f"{base}/usage", f"{base}/checkpoint").awaitTermination()
    latest = usage_stream.latest_versions(
        spark.read.parquet(f"{base}/usage"), ["provider_name", "model_name", "date"]
    )
    return latest.withColumn("average_latency_ms", F.round("average_latency_ms", 9))
