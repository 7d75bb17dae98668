"""The four stages over a versioned store: each is one commit that writes only what it adds or touches.

A stage that breaks leaves the store as it was, so running it again continues where the written status left off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from capledger.operators import dedup, status as stage_status
from capledger.operators.entities import created_investors, investor_links
from capledger.options import DedupOptions
from capledger.plans import stages
from capledger.session import sized
from capledger.sources.store import Store, Transaction


def register_companies(store: Store, names: DataFrame, now: Column) -> None:
    """Stage 1: new companies and their status rows."""
    with store.transaction() as tx:
        known = tx.read("companies")
        fresh = names.select("name").where(F.col("name").isNotNull()).distinct().join(known, "name", "left_anti")
        created, status = stages.register_companies(fresh, known.limit(0), tx.read("processing_status").limit(0), now)
        created = tx.keep(created)
        tx.append("companies", created)
        tx.append("processing_status", stage_status.initial_status(created, now).select(status.columns))


def _pending(tx: Transaction, stage: int) -> tuple[DataFrame, DataFrame]:
    """Companies whose flag of a stage is not set, and their status rows."""
    flag = stage_status.STAGES[stage][0]
    status = sized(tx.keep(tx.read("processing_status").where(~F.col(flag))))
    companies = tx.read("companies").join(status.select(F.col("company_id").alias("id")), "id", "left_semi")
    return companies, status


def _save(tx: Transaction, done: stages.Collected, known: DataFrame, now: Column) -> None:
    named = tx.keep(done.named)
    created = tx.keep(created_investors(known, named, now))
    ids = sized(known.unionByName(created), tx.count_at_most("investors") + created.count())
    tx.append("funding_rounds", done.rounds)
    tx.append("sources", done.sources)
    tx.append("investors", created)
    tx.append("round_investors", investor_links(named, ids))
    tx.change("processing_status", done.status)


def collect_filings(store: Store, directory: DataFrame, indexes: DataFrame, documents: DataFrame, now: Column) -> None:
    """Stage 2: ids and filings of the companies it is still open for."""
    with store.transaction() as tx:
        companies, status = _pending(tx, 2)
        investors = tx.read("investors")
        done = stages.collect_filings(companies, status, investors, directory, indexes, documents, now, tx.keep)
        _save(tx, done, investors, now)
        tx.change("companies", done.companies.where(F.col("updated_at") == now))


def collect_search(store: Store, hits: DataFrame, responses: DataFrame, strategy: str, now: Column) -> None:
    """Stage 3: rounds in model answers for the companies it is still open for."""
    with store.transaction() as tx:
        companies, status = _pending(tx, 3)
        investors = tx.read("investors")
        done = stages.collect_search(companies, status, investors, hits, responses, strategy, now, tx.keep)
        _save(tx, done, investors, now)


def merge_rounds(store: Store, now: Column, options: DedupOptions = dedup.DEFAULTS) -> None:
    """Stage 4: marks of the rounds of companies not merged yet, and their counts."""
    with store.transaction() as tx:
        status = tx.read("processing_status")
        # Not kept: a version's files stay as they are, and most steps read few of the columns.
        pending = dedup.pending_rounds(tx.read("funding_rounds"), status)
        lost = sized(tx.keep(dedup.losers(pending, options)))
        losing = pending.join(lost.select(F.col("round_id").alias("id")), "id", "left_semi").select(pending.columns)
        tx.change("funding_rounds", dedup.mark_duplicates(losing, lost))
        counts = dedup.unique_rounds_per_company(dedup.mark_duplicates(pending, lost))
        log = counts.select("company_id", now.alias("at"), F.lit(True).alias("completed"), F.col("unique_rounds").alias("counted"))
        touched = status.join(counts.select("company_id"), "company_id", "left_semi").select(status.columns)
        touched = sized(touched, tx.count_at_most("processing_status"))
        tx.change("processing_status", stage_status.apply_completions(touched, log, 4))


def reset_stages(store: Store, numbers: tuple[int, ...] = (2, 3, 4)) -> None:
    """Clear stages of the companies that have any of them set; rounds stay."""
    own = [n for n in numbers if n in (2, 3, 4)]
    if not own:
        return
    with store.transaction() as tx:
        status = tx.read("processing_status")
        held = F.lit(False)
        for n in own:
            flag, at, counter = stage_status.STAGES[n]
            held |= F.col(flag) | F.col(at).isNotNull() | (F.coalesce(counter, F.lit(0)) != 0)
        tx.change("processing_status", stage_status.reset_status(status.where(held), tuple(own)))


def complete_stage(store: Store, log: DataFrame, stage: int) -> None:
    """Completions (company_id, at, completed, counted) of a stage: the status rows they name, created if missing."""
    with store.transaction() as tx:
        status = tx.read("processing_status")
        touched = status.join(log.select("company_id"), "company_id", "left_semi").select(status.columns)
        touched = sized(touched, tx.count_at_most("processing_status"))
        tx.change("processing_status", stage_status.apply_completions(touched, log, stage))
