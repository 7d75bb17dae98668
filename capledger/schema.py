"""Table (T1..T7) and landed-record (L2..L7) schemas, and the constraints on them."""

from __future__ import annotations

from dataclasses import dataclass

COMPANIES = """id BIGINT, name STRING, cik STRING, official_name STRING,
created_at TIMESTAMP, updated_at TIMESTAMP"""

FUNDING_ROUNDS = """id BIGINT, company_id BIGINT, round_name STRING, date STRING,
amount_raised_usd DOUBLE, pre_money_valuation_usd DOUBLE, post_money_valuation_usd DOUBLE,
lead_investor STRING, source_type STRING, confidence_score STRING,
source_urls ARRAY<STRING>, notes STRING, raw_data STRING, is_duplicate BOOLEAN,
duplicate_of_id BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP"""

INVESTORS = "id BIGINT, name STRING, investor_type STRING, created_at TIMESTAMP, updated_at TIMESTAMP"

ROUND_INVESTORS = "round_id BIGINT, investor_id BIGINT"

SOURCES = """id BIGINT, round_id BIGINT, source_type STRING, url STRING, title STRING,
snippet STRING, llm_provider STRING, llm_model STRING, extraction_confidence STRING,
created_at TIMESTAMP"""

PROCESSING_STATUS = """id BIGINT, company_id BIGINT,
stage1_resolved BOOLEAN, stage1_completed_at TIMESTAMP,
stage2_sec_collected BOOLEAN, stage2_completed_at TIMESTAMP, stage2_rounds_found INT,
stage3_search_extracted BOOLEAN, stage3_completed_at TIMESTAMP, stage3_rounds_found INT,
stage4_merged BOOLEAN, stage4_completed_at TIMESTAMP, stage4_unique_rounds INT,
has_errors BOOLEAN, error_message STRING, retry_count INT,
created_at TIMESTAMP, updated_at TIMESTAMP"""

LLM_USAGE = """id BIGINT, provider_name STRING, model_name STRING,
total_calls BIGINT, successful_calls BIGINT, failed_calls BIGINT, rate_limited_calls BIGINT,
total_input_tokens BIGINT, total_output_tokens BIGINT,
average_latency_ms DOUBLE, min_latency_ms DOUBLE, max_latency_ms DOUBLE, date STRING,
created_at TIMESTAMP, updated_at TIMESTAMP"""

TABLES = {
    "companies": COMPANIES,
    "funding_rounds": FUNDING_ROUNDS,
    "investors": INVESTORS,
    "round_investors": ROUND_INVESTORS,
    "sources": SOURCES,
    "processing_status": PROCESSING_STATUS,
    "llm_usage": LLM_USAGE,
}

TICKER_DIRECTORY = "map<string, struct<cik_str: bigint, title: string>>"

FILINGS_INDEX = (
    "struct<filings: struct<recent: struct<"
    "form: array<string>, filingDate: array<string>, accessionNumber: array<string>>>>"
)

RESPONSE_ROUND = (
    "struct<round_name: string, date: string, amount_raised_usd: string, "
    "pre_money_valuation_usd: string, post_money_valuation_usd: string, "
    "lead_investor: string, all_investors: array<string>, source_url: string, notes: string>"
)

NOT_NULL = {
    "companies": ["id", "name", "created_at", "updated_at"],
    "funding_rounds": [
        "id", "company_id", "source_type", "confidence_score", "is_duplicate", "created_at", "updated_at",
    ],
    "investors": ["id", "name", "created_at", "updated_at"],
    "round_investors": ["round_id", "investor_id"],
    "sources": ["id", "round_id", "source_type", "created_at"],
    "processing_status": [
        "id", "company_id", "stage1_resolved", "stage2_sec_collected", "stage2_rounds_found",
        "stage3_search_extracted", "stage3_rounds_found", "stage4_merged", "stage4_unique_rounds",
        "has_errors", "retry_count", "created_at", "updated_at",
    ],
    "llm_usage": [
        "id", "provider_name", "model_name", "total_calls", "successful_calls", "failed_calls",
        "rate_limited_calls", "total_input_tokens", "total_output_tokens", "date", "created_at", "updated_at",
    ],
}

MAX_LENGTH = {
    "companies": {"name": 500, "cik": 20, "official_name": 500},
    "funding_rounds": {
        "round_name": 100, "date": 50, "lead_investor": 500, "source_type": 50, "confidence_score": 20,
    },
    "investors": {"name": 500, "investor_type": 50},
    "sources": {
        "source_type": 50, "url": 2000, "title": 500, "llm_provider": 50, "llm_model": 100,
        "extraction_confidence": 20,
    },
    "llm_usage": {"provider_name": 50, "model_name": 100, "date": 10},
}

UNIQUE_KEYS = {
    "companies": ["name"],
    "investors": ["name"],
    "processing_status": ["company_id"],
    "round_investors": ["round_id", "investor_id"],
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str


FOREIGN_KEYS = (
    ForeignKey("funding_rounds", "company_id", "companies"),
    ForeignKey("funding_rounds", "duplicate_of_id", "funding_rounds"),
    ForeignKey("round_investors", "round_id", "funding_rounds"),
    ForeignKey("round_investors", "investor_id", "investors"),
    ForeignKey("sources", "round_id", "funding_rounds"),
    ForeignKey("processing_status", "company_id", "companies"),
)
