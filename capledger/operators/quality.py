"""Declared constraints as data checks, and cascading deletes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from capledger.schema import FOREIGN_KEYS, MAX_LENGTH, NOT_NULL, UNIQUE_KEYS, ForeignKey
from capledger.session import spread


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """(key, rows): foreign key values without a parent, and how many rows hold each.

    Rows are counted per value before the join, so a popular key costs one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(
        F.count("*").alias("rows")
    )
    return used.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def orphan_report(tables: dict[str, DataFrame], keys: tuple[ForeignKey, ...] = FOREIGN_KEYS) -> DataFrame:
    """(child, column_name, parent, orphan_keys, orphan_rows) per foreign key of given tables."""
    parts = [
        orphan_keys(tables[k.child], k.column, tables[k.parent]).agg(
            F.lit(k.child).alias("child"), F.lit(k.column).alias("column_name"),
            F.lit(k.parent).alias("parent"), F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
        )
        for k in keys if k.child in tables and k.parent in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def uniqueness_report(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        repeated_keys(tables[t], key).agg(
            F.lit(t).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
            F.count("*").alias("repeated_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_involved"),
        )
        for t, key in UNIQUE_KEYS.items() if t in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def column_report(name: str, df: DataFrame) -> DataFrame:
    """(table_name, column_name, rule, violations) of the NOT NULL and length rules, in one pass."""
    checks = [(c, "not_null", F.col(c).isNull()) for c in NOT_NULL.get(name, []) if c in df.columns]
    checks += [
        (c, f"max_length_{n}", F.length(c) > n)
        for c, n in MAX_LENGTH.get(name, {}).items() if c in df.columns
    ]
    counted = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"), F.col(f"c{i}").alias("violations"),
        )
        for i, (column, rule, _) in enumerate(checks)
    ])
    return counted.select(F.inline(rows))


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [column_report(n, df) for n, df in tables.items()])


def delete_companies(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """The tables without the companies in ``gone`` (id) and everything that hangs on them."""
    company = gone.select(F.col("id").alias("company_id")).distinct()
    rounds = tables["funding_rounds"]
    gone_rounds = rounds.join(company, "company_id", "left_semi").select(F.col("id").alias("round_id"))
    # The keys are spread as the table asks for: the optimizer would put off spreading the table itself behind the join.
    lost = {name: spread(gone_rounds, "round_id", like=tables[name]) for name in ("round_investors", "sources")}
    return {
        "companies": tables["companies"].join(gone.select("id"), "id", "left_anti"),
        "funding_rounds": rounds.join(company, "company_id", "left_anti").select(rounds.columns),
        "processing_status": tables["processing_status"].join(company, "company_id", "left_anti")
        .select(tables["processing_status"].columns),
        "round_investors": tables["round_investors"].join(lost["round_investors"], "round_id", "left_anti"),
        "sources": tables["sources"].join(lost["sources"], "round_id", "left_anti")
        .select(tables["sources"].columns),
    }
