"""The four stages over stored tables. Each returns new tables for the caller to write.

Results that several outputs of a stage derive from (resolved ids, extracted rounds, marks)
are written once, by default to the checkpoint folder (``keep``), so documents and answers are read once. Every stage takes only companies whose flag for it is not set, so running it again after an
interruption continues where the written status left off.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from capledger.functions.text import has_text
from capledger.operators import dedup
from capledger.operators.entities import (
    exploded_investors, investor_links, upsert_companies, upsert_investors,
)
from capledger.operators.resolve import resolve_companies
from capledger.operators.rounds import (
    HIGH, MEDIUM, SEC, WEB, filing_sources, form_d_records, response_records, round_rows, web_sources,
)
from capledger.operators.status import apply_completions, initial_status, pending_work
from capledger.options import DedupOptions
from capledger.session import materialize, sized
from capledger.sources.filings import filings, offering_filings


@dataclass(frozen=True)
class Collected:
    """What a collecting stage adds: rounds, their sources and investors (also as named in rounds), and the new status."""

    rounds: DataFrame
    sources: DataFrame
    investors: DataFrame
    round_investors: DataFrame
    status: DataFrame
    companies: DataFrame
    named: DataFrame


def _stage_log(todo: DataFrame, rounds: DataFrame, now: Column) -> DataFrame:
    """A completion per pending company, with its number of rounds (also when it has none)."""
    found = rounds.groupBy("company_id").agg(F.count("*").alias("counted"))
    return todo.select(F.col("id").alias("company_id")).join(found, "company_id", "left").select(
        "company_id", now.alias("at"), F.lit(True).alias("completed"),
        F.coalesce("counted", F.lit(0)).alias("counted"),
    )


def register_companies(
    names: DataFrame, companies: DataFrame, status: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Stage 1: take in listed names; new companies get a status row."""
    nothing = F.lit(None).cast("string")
    incoming = names.select("name", nothing.alias("cik"), nothing.alias("official_name"))
    registered = upsert_companies(companies, incoming, now)
    created = registered.join(companies.select("id"), "id", "left_anti")
    return registered, status.unionByName(initial_status(created, now).select(status.columns))


def collect_filings(
    companies: DataFrame, status: DataFrame, investors: DataFrame, directory: DataFrame,
    indexes: DataFrame, documents: DataFrame, now: Column, keep: Callable[[DataFrame], DataFrame] = materialize,
) -> Collected:
    """Stage 2: resolve ids, read filing indexes (cik, payload) and documents
    (cik, accession_number, document)."""
    todo = pending_work(companies, status, 2).select("id")
    pending = companies.join(todo, "id", "left_semi")
    unresolved = pending.where(~has_text(F.col("cik"))).select("id", "name")
    resolved = keep(resolve_companies(unresolved, directory)).where(
        F.col("cik").isNotNull()
    ).select(
        "id", F.col("cik").alias("found_cik"), F.col("official_name").alias("found_name"),
        F.lit(True).alias("found"),
    )
    found = F.coalesce("found", F.lit(False))
    updated = companies.join(resolved, "id", "left").select(
        "id", "name",
        F.when(found, F.col("found_cik")).otherwise(F.col("cik")).alias("cik"),
        F.when(found, F.col("found_name")).otherwise(F.col("official_name")).alias("official_name"),
        "created_at", F.when(found, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    owners = updated.join(todo, "id", "left_semi").select(
        F.col("id").alias("company_id"), F.col("name").alias("company_name"), "cik"
    )
    filed = offering_filings(filings(indexes)).join(documents, ["cik", "accession_number"])
    rounds = keep(round_rows(form_d_records(owners.join(filed, "cik")), SEC, HIGH, now))
    return _collected(rounds, filing_sources(rounds, now), investors, status, todo, updated, 2, now)


def collect_search(
    companies: DataFrame, status: DataFrame, investors: DataFrame, hits: DataFrame,
    responses: DataFrame, strategy: str, now: Column, keep: Callable[[DataFrame], DataFrame] = materialize,
) -> Collected:
    """Stage 3: rounds in model answers (company_id, response), described by search hits."""
    todo = sized(pending_work(companies, status, 3))
    answers = responses.join(
        todo.select(F.col("id").alias("company_id"), F.col("name").alias("company_name")), "company_id"
    )
    rounds = keep(round_rows(response_records(answers), WEB, MEDIUM, now))
    sources = web_sources(rounds, hits, strategy, now)
    return _collected(rounds, sources, investors, status, todo, companies, 3, now)


def _collected(
    rounds: DataFrame, sources: DataFrame, investors: DataFrame, status: DataFrame,
    todo: DataFrame, companies: DataFrame, stage: int, now: Column,
) -> Collected:
    named = exploded_investors(rounds)
    known = upsert_investors(investors, named, now)
    new_status = apply_completions(status, _stage_log(todo, rounds, now), stage)
    return Collected(
        rounds.drop("all_investors", "source_url"), sources, known,
        investor_links(named, known), new_status, companies, named,
    )


def merge_rounds(
    rounds: DataFrame, status: DataFrame, now: Column, options: DedupOptions = dedup.DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """Stage 4: mark duplicates of companies not merged yet; (rounds, status)."""
    pending = dedup.pending_rounds(rounds, status)
    merged = dedup.mark_duplicates(rounds, materialize(dedup.losers(pending, options)))
    touched = pending.select("company_id").distinct()
    counts = dedup.unique_rounds_per_company(merged.join(touched, "company_id", "left_semi"))
    log = counts.select(
        "company_id", now.alias("at"), F.lit(True).alias("completed"),
        F.col("unique_rounds").alias("counted"),
    )
    return merged, apply_completions(status, log, 4)
