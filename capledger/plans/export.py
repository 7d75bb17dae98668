"""Writing export rows. Spark writes a folder of part files per format."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from capledger.options import ExportOptions
from capledger.session import checkpoint_root

_MONEY = ("Amount Raised (USD)", "Pre-Money Valuation (USD)", "Post-Money Valuation (USD)")


def target(options: ExportOptions, extension: str, at: dt.datetime) -> str:
    """Output folder named after the time of the export."""
    stem = options.filename_template.format(timestamp=at.strftime("%Y%m%d_%H%M%S"))
    return f"{options.output_directory.rstrip('/')}/{stem}.{extension}"


def plain_money(amount: Column) -> Column:
    """An amount as text: plain digits with two decimals or more where that is exact, else as Spark prints it."""
    exact = amount.try_cast("decimal(38,12)")
    digits = F.regexp_replace(exact.cast("string"), r"(\.\d\d\d*?)0+$", "$1")
    return F.when(exact.cast("double") == amount.cast("double"), digits).otherwise(amount.cast("string"))


def write_csv(rows: DataFrame, path: str) -> None:
    """Header, minimal quoting, doubled quotes, empty cells for null; money in plain notation without loss."""
    plain = rows.withColumns({m: plain_money(F.col(m)) for m in _MONEY if m in rows.columns})
    plain.write.csv(
        path, header=True, escape='"', nullValue="", emptyValue="", encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object per line, nulls kept."""
    rows.write.json(path, ignoreNullFields=False, encoding="UTF-8")


def write_sheet(rows: DataFrame, path: str) -> None:
    """The rows of the spreadsheet export, as Parquet."""
    rows.write.parquet(path)


_WRITERS = {"excel": (write_sheet, "parquet"), "csv": (write_csv, "csv"), "json": (write_json, "json")}


def export_all(rows: DataFrame, options: ExportOptions, at: dt.datetime | None = None) -> dict[str, str | None]:
    """Write every configured format from one evaluation; {format: folder, or None if no rows}."""
    at = at or dt.datetime.now()
    spark = rows.sparkSession
    # Evaluated once into Parquet, which takes a fraction of what a checkpoint of the rows would.
    draft = f"{checkpoint_root(spark).rstrip('/')}/capledger-export-{uuid.uuid4().hex}"
    written: dict[str, str | None] = {}
    try:
        rows.write.parquet(draft)
        rows = spark.read.schema(rows.schema).parquet(draft)
        empty = rows.isEmpty()
        for name, (write, extension) in _WRITERS.items():
            if name not in options.formats:
                continue
            written[name] = None
            if not empty:
                written[name] = target(options, extension, at)
                write(rows, written[name])
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(draft)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return written
