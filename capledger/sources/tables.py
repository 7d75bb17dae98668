"""Stored tables: Parquet folders, or a database read in key ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from capledger.schema import TABLES


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the seven tables, with its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def write_table(df: DataFrame, root: str, name: str, mode: str = "append") -> None:
    """Write the declared columns of a table; one job, committed as a whole."""
    declared = [field.split()[0] for field in TABLES[name].replace("\n", " ").split(", ")]
    df.select(*declared).write.mode(mode).parquet(f"{root}/{name}")


def read_database_table(
    spark: SparkSession, url: str, name: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """The same table from a relational database, split on ``id`` (or the bridge's round)."""
    key = "round_id" if name == "round_investors" else "id"
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=name, partitionColumn=key, lowerBound=str(lower),
            upperBound=str(upper), numPartitions=str(partitions), **options,
        )
        .load()
    )
