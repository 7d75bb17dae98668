"""Company financing events as Spark DataFrames: ingest, resolve, de-duplicate, report."""

__version__ = "0.1.0"
