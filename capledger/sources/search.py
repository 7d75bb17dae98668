"""Search: the queries to run, the hits that came back, and the prompts built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from capledger.functions.search import hit_block, prompt, search_queries
from capledger.functions.text import text_or_empty
from capledger.options import SearchOptions

DEFAULTS = SearchOptions()


def company_queries(companies: DataFrame) -> DataFrame:
    """(company_id, query_no, query), one row per template."""
    return companies.select(
        F.col("id").alias("company_id"),
        F.inline(search_queries(F.col("name"))),
    )


def search_hits(landed: DataFrame, options: SearchOptions = DEFAULTS) -> DataFrame:
    """The first hits of every query, renamed; missing texts are empty.

    ``landed`` has company_id, query_no, rank, title, href, body. Ranking with a limit keeps
    at most ``max_results_per_query`` rows per group before anything is shuffled.
    """
    by_query = Window.partitionBy("company_id", "query_no").orderBy("rank", "href", "title", "body")
    return (
        landed.withColumn("place", F.row_number().over(by_query))
        .where(F.col("place") <= options.max_results_per_query)
        .select(
            "company_id", "query_no", F.col("place").alias("rank"),
            text_or_empty(F.col("title")).alias("title"),
            text_or_empty(F.col("href")).alias("url"),
            text_or_empty(F.col("body")).alias("snippet"),
        )
    )


def company_prompts(hits: DataFrame, companies: DataFrame) -> DataFrame:
    """(company_id, prompt) for companies with hits, hits numbered in search order.

    ``hits`` come from ``search_hits``, so a company has at most queries x results of them.
    """
    listed = hits.groupBy("company_id").agg(
        F.array_sort(
            F.collect_list(F.struct("query_no", "rank", "title", "url", "snippet"))
        ).alias("hits")
    )
    blocks = F.array_join(
        F.transform("hits", lambda h, i: hit_block(i + 1, h["title"], h["url"], h["snippet"])), ""
    )
    names = companies.select(F.col("id").alias("company_id"), "name")
    return listed.join(names, "company_id").select(
        "company_id", prompt(F.col("name"), blocks).alias("prompt")
    )


def answer_prompts(prompts: DataFrame, answer, column: str = "prompt") -> DataFrame:
    """Add ``response`` by calling ``answer(list of prompts) -> list of texts`` per Arrow batch.

    The one place where user code runs; everything before and after it is column expressions.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prompts.schema)

    def respond(batches):
        for batch in batches:
            yield batch.assign(response=list(answer(batch[column].tolist())))

    return prompts.mapInPandas(respond, f"{schema}, response string")
