"""Options, with the documented defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DedupOptions:
    """How two rounds of one company are judged to be the same event.

    ``dense_company_rows`` only chooses between two exact plans (see ``operators.dedup``):
    companies with at most this many dated rounds are compared pair by pair, larger ones
    by date windows: rounds in windows of at most ``window_rows`` meet directly, so that a round meets a bounded
    number of others, all the rest never do. Companies with more than ``slice_rows`` rounds in that rest have their
    sorted runs cut into slices.
    """

    date_proximity_days: int = 90
    amount_similarity_threshold: float = 0.10
    enable_fuzzy_matching: bool = True
    dense_company_rows: int = 1000
    slice_rows: int = 100_000
    window_rows: int = 32

    def __post_init__(self) -> None:
        if self.date_proximity_days < 0 or not 0 <= self.amount_similarity_threshold < 1:
            raise ValueError("date proximity must not be negative, similarity must be in [0, 1)")


@dataclass(frozen=True)
class SearchOptions:
    max_results_per_query: int = 4


@dataclass(frozen=True)
class ExportOptions:
    output_directory: str = "data/exports"
    filename_template: str = "funding_rounds_{timestamp}"
    formats: tuple[str, ...] = ("excel", "csv", "json")
