"""Company names from a CSV list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from capledger.functions.text import strip, text_or_null

# Accepted headers, in order of preference.
NAME_HEADERS = ("Companies", "company", "Company")


def _columns_by_header(columns: list[str]) -> dict[str, str]:
    """Header -> column name. Headers that differ only by case come back numbered by position."""
    found = {}
    for position, column in enumerate(columns):
        suffix = str(position)
        if column in NAME_HEADERS:
            found.setdefault(column, column)
        elif column.endswith(suffix) and column[: -len(suffix)] in NAME_HEADERS:
            found.setdefault(column[: -len(suffix)], column)
    return found


def read_company_list(
    spark: SparkSession, path: str, limit: int | None = None, multi_line: bool = False
) -> DataFrame:
    """(name) of each row that has a non-empty name, stripped; the first ``limit`` in file order.

    A name that is only white space stays as empty text. A missing file raises. Set
    ``multi_line`` when quoted names may hold line breaks; such files are read unsplit.
    """
    rows = spark.read.csv(path, header=True, escape='"', multiLine=multi_line, encoding="UTF-8")
    by_header = _columns_by_header(rows.columns)
    candidates = [text_or_null(F.col(f"`{by_header[h]}`")) for h in NAME_HEADERS if h in by_header]
    if not candidates:
        return spark.createDataFrame([], "name STRING")
    position = ("_metadata.file_name", "_metadata.file_block_start")
    named = rows.select(
        F.coalesce(*candidates).alias("raw_name"),
        *[F.col(p).alias(f"at{i}") for i, p in enumerate(position)],
        F.monotonically_increasing_id().alias("at_row"),
    ).where(F.col("raw_name").isNotNull())
    if limit:
        named = named.orderBy("at0", "at1", "at_row").limit(limit)
    return named.select(strip(F.col("raw_name")).alias("name"))
