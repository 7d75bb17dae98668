"""Search queries, extraction prompts and the rounds inside a model's answer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from capledger.schema import RESPONSE_ROUND

# Query templates.
QUERY_TEMPLATES = (
    'site:techcrunch.com "{company}" funding raised Series',
    'site:crunchbase.com "{company}" funding rounds',
    'site:reuters.com OR site:bloomberg.com "{company}" raises funding',
    'site:pitchbook.com OR site:cbinsights.com "{company}" venture capital',
    'site:theinformation.com OR site:axios.com "{company}" funding',
    'site:venturebeat.com OR site:geekwire.com "{company}" raises',
    'site:wsj.com OR site:ft.com OR site:forbes.com "{company}" investment',
    '"{company}" funding history seed series valuation investors',
)


def search_queries(company: Column) -> Column:
    """array<struct<query_no, query>>: one query per template, numbered from 1."""
    return F.array(*[
        F.struct(
            F.lit(number).alias("query_no"),
            F.replace(F.lit(template), F.lit("{company}"), company).alias("query"),
        )
        for number, template in enumerate(QUERY_TEMPLATES, 1)
    ])


# The prompt around the search results.
PROMPT_HEAD = """You are a financial data analyst extracting funding round information from web search results.

Company: {company}

Search Results:
"""
PROMPT_TAIL = """

Extract ALL funding rounds mentioned for {company}. For each round, extract:
- round_name (e.g., "Seed", "Series A", "Series B", "Series C", etc.)
- date (YYYY-MM-DD or YYYY-MM or YYYY)
- amount_raised_usd (number only, in USD)
- pre_money_valuation_usd (if mentioned, number only)
- post_money_valuation_usd (if mentioned, number only)
- lead_investor (primary investor if mentioned)
- all_investors (list of all investors mentioned)
- source_url (which URL this data came from)

Return ONLY a valid JSON array of funding rounds. If no funding rounds are found, return an empty array [].

Example format:
[
  {{
    "round_name": "Series A",
    "date": "2020-05-15",
    "amount_raised_usd": 50000000,
    "pre_money_valuation_usd": null,
    "post_money_valuation_usd": 250000000,
    "lead_investor": "Sequoia Capital",
    "all_investors": ["Sequoia Capital", "Andreessen Horowitz"],
    "source_url": "https://techcrunch.com/..."
  }}
]

JSON array:"""


def hit_block(number: Column, title: Column, url: Column, snippet: Column) -> Column:
    """One numbered search result as it appears in a prompt."""
    return F.concat(
        F.lit("\n\n--- Result "), number.cast("string"), F.lit(" ---\nTitle: "), title,
        F.lit("\nURL: "), url, F.lit("\nSnippet: "), snippet, F.lit("\n"),
    )


def prompt(company: Column, blocks: Column) -> Column:
    name = F.lit("{company}")
    return F.concat(
        F.replace(F.lit(PROMPT_HEAD), name, company), blocks,
        F.replace(F.lit(PROMPT_TAIL), name, company),
    )


def array_slice(response: Column) -> Column:
    """From the first ``[`` to the last ``]``; null when there is no such slice."""
    return F.nullif(F.regexp_extract(response, r"(?s)\[.*\]", 0), F.lit(""))


def response_rounds(response: Column) -> Column:
    """array<struct> of the rounds in an answer, all scalars as text.

    Invalid JSON, or an element that is not an object, voids the whole answer (null).
    """
    return F.from_json(array_slice(response), f"array<{RESPONSE_ROUND}>")


def response_objects(response: Column) -> Column:
    """array<string> of the same rounds, each the whole JSON object."""
    return F.from_json(array_slice(response), "array<string>")
