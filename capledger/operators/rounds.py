"""From extracted records to rows of funding_rounds and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from capledger.functions.filings import archive_url, offering
from capledger.functions.numbers import number_from_text
from capledger.functions.search import response_objects, response_rounds
from capledger.functions.text import has_text, truncated_title
from capledger.operators.entities import key_of

# Fixed values.
SEC, WEB = "SEC_FORM_D", "WEB_SEARCH"
HIGH, MEDIUM = "HIGH", "MEDIUM"
FORM_D_ROUND = "Form D Filing"

_FACTS = [
    "round_name", "date", "amount_raised_usd", "pre_money_valuation_usd", "post_money_valuation_usd",
    "lead_investor", "all_investors", "source_url", "notes",
]


def form_d_records(documents: DataFrame) -> DataFrame:
    """Round records of offering documents.

    ``documents`` has company_id, company_name, cik, filing_date, accession_number, document.
    Documents that are not offerings give nothing; an unreadable amount is null.
    """
    number = F.lit(None).cast("double")
    return (
        documents.select("*", F.inline(F.array(offering(F.col("document")))))
        .where(F.col("is_offering"))
        .select(
            "company_id", "company_name",
            F.lit(FORM_D_ROUND).alias("round_name"),
            F.col("filing_date").alias("date"),
            F.col("amount").alias("amount_raised_usd"),
            number.alias("pre_money_valuation_usd"),
            number.alias("post_money_valuation_usd"),
            F.lit(None).cast("string").alias("lead_investor"),
            F.array().cast("array<string>").alias("all_investors"),
            archive_url(F.col("cik"), F.col("accession_number")).alias("source_url"),
            F.concat(
                F.lit("SEC Form D filing (Accession: "), F.col("accession_number"), F.lit(")")
            ).alias("notes"),
        )
    )


def response_records(responses: DataFrame) -> DataFrame:
    """Round records inside model answers (company_id, company_name, response).

    ``position`` is the place in the answer and ``raw`` the whole object as the answer has it.
    """
    money = ("amount_raised_usd", "pre_money_valuation_usd", "post_money_valuation_usd")
    answer = F.col("response")
    found = F.arrays_zip(response_rounds(answer).alias("record"), response_objects(answer).alias("raw"))
    return responses.select("company_id", "company_name", F.posexplode(found).alias("position", "found")).select(
        "company_id", "company_name", "found.record.*", "position", F.col("found.raw").alias("raw")
    ).withColumns({m: number_from_text(F.col(m)) for m in money})


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Answers that hold text but no readable array of rounds."""
    return responses.where(
        has_text(F.col("response")) & response_rounds(F.col("response")).isNull()
    )


def round_rows(records: DataFrame, source_type: str, confidence: str, now: Column) -> DataFrame:
    """Rows of funding_rounds, plus all_investors and source_url for the steps that follow.

    Every record is a row of its own: the id is a key over company, source, content, place in the
    answer, time of the run and, among records that agree in all of these, a number. A second run adds
    rows that de-duplication compares with those of the first.
    """
    url = F.col("source_url")
    urls = F.array(url) if source_type == SEC else F.when(has_text(url), F.array(url))
    if "raw" in records.columns:
        raw, place = F.col("raw"), [F.col("position")]
    else:
        kind = (F.lit(source_type).alias("source_type"), F.lit(confidence).alias("confidence_score"))
        raw, place = F.to_json(F.struct("company_name", *_FACTS, *kind), {"ignoreNullFields": "false"}), []
    key = key_of("company_id", F.lit(source_type), "raw_data", now.cast("string"), *place)
    keyed = records.withColumn("raw_data", raw).withColumn("record_key", key).withColumn(
        "copy", F.row_number().over(Window.partitionBy("record_key").orderBy("company_id"))
    )
    return keyed.select(
        key_of("record_key", "copy").alias("id"),
        "company_id", "round_name", "date", "amount_raised_usd",
        "pre_money_valuation_usd", "post_money_valuation_usd", "lead_investor",
        F.lit(source_type).alias("source_type"),
        F.lit(confidence).alias("confidence_score"),
        urls.alias("source_urls"),
        "notes", "raw_data",
        F.lit(False).alias("is_duplicate"),
        F.lit(None).cast("bigint").alias("duplicate_of_id"),
        now.alias("created_at"), now.alias("updated_at"),
        "all_investors", "source_url",
    )


def all_rounds(sec_rounds: DataFrame, web_rounds: DataFrame) -> DataFrame:
    return sec_rounds.unionByName(web_rounds)


def _source_row(
    kind: str, title: Column, snippet: Column, provider: Column, confidence: Column, now: Column
) -> list[Column]:
    return [
        key_of(F.col("id"), F.lit(kind), "source_url").alias("id"),
        F.col("id").alias("round_id"),
        F.lit(kind).alias("source_type"),
        F.col("source_url").alias("url"),
        truncated_title(title).alias("title"),
        snippet.alias("snippet"),
        provider.cast("string").alias("llm_provider"),
        F.lit(None).cast("string").alias("llm_model"),
        confidence.cast("string").alias("extraction_confidence"),
        now.alias("created_at"),
    ]


def filing_sources(sec_rounds: DataFrame, now: Column) -> DataFrame:
    """One source per filing round; a missing date prints as ``None`` in the title."""
    title = F.concat(F.lit("SEC Form D - "), F.coalesce("date", F.lit("None")))
    return sec_rounds.select(*_source_row(SEC, title, F.col("notes"), F.lit(None), F.lit(None), now))


def first_hits(hits: DataFrame) -> DataFrame:
    """(company_id, url, title, snippet) of the first hit of each address, in search order."""
    first = F.min(F.struct("query_no", "rank", "title", "snippet")).alias("hit")
    return hits.groupBy("company_id", "url").agg(first).select(
        "company_id", "url", F.col("hit.title").alias("title"), F.col("hit.snippet").alias("snippet")
    )


def web_sources(web_rounds: DataFrame, hits: DataFrame, strategy: str, now: Column) -> DataFrame:
    """One source per web round that names an address, described by the first hit there."""
    addressed = web_rounds.where(has_text(F.col("source_url")))
    described = first_hits(hits).withColumnRenamed("url", "source_url")
    return addressed.join(described, ["company_id", "source_url"], "left").select(
        *_source_row(WEB, F.col("title"), F.col("snippet"), F.lit(strategy), F.lit(MEDIUM), now)
    )


def rounds_found(rounds: DataFrame) -> DataFrame:
    """Stage counters: rounds per company and source."""
    return rounds.groupBy("company_id", "source_type").agg(F.count("*").alias("rounds_found"))


def rounds_for_company(rounds: DataFrame, company_id: int, exclude_duplicates: bool = True) -> DataFrame:
    own = rounds.where(F.col("company_id") == company_id)
    return non_duplicates(own) if exclude_duplicates else own


def non_duplicates(rounds: DataFrame) -> DataFrame:
    return rounds.where(~F.col("is_duplicate"))
