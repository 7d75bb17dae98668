"""Landed regulator payloads: ticker directory, filings index, offering documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from capledger.functions.filings import index_rows
from capledger.functions.text import has_text
from capledger.schema import TICKER_DIRECTORY


def directory_entries(
    payloads: DataFrame, column: str = "payload", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(ordinal, title, cik) of a ticker directory, in document order; ``keep`` adds columns."""
    entries = F.map_entries(F.from_json(F.col(column), TICKER_DIRECTORY))
    return payloads.select(*keep, F.posexplode(entries).alias("ordinal", "entry")).select(
        *keep,
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.col("entry.value.title").alias("title"),
        F.col("entry.value.cik_str").alias("cik"),
    )


def filings(indexes: DataFrame, column: str = "payload") -> DataFrame:
    """One row per filing of each index: its other columns, form, filing_date, accession_number."""
    others = [c for c in indexes.columns if c != column]
    return indexes.select(*others, F.inline(index_rows(F.col(column))))


def offering_filings(filings_df: DataFrame) -> DataFrame:
    """Filings of form D itself (not its amendments) that have an accession number."""
    return filings_df.where((F.col("form") == "D") & has_text(F.col("accession_number")))
