"""Queries over the column expressions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from capledger.checks import shapes
from capledger.checks.registry import query
from capledger.checks.shapes import sql, table
from capledger.functions import dates, numbers, search, text
from capledger.operators import entities, rounds as records
from capledger.session import spread
from capledger.sources import filings as filing_source, search as search_source


@query(sql("SELECT id, date, day FROM t_features"))
def parsed_dates(spark, root):
    return shapes.rounds(spark, root).select(
        "id", "date", dates.parsed_date(F.col("date")).alias("day")
    )


@query(sql("""
    SELECT l_orderkey, l_linenumber,
           coalesce(abs(date_diff('day', day, CAST(l_shipdate AS DATE))) <= 90, false) AS is_close,
           count(*) AS lines
    FROM lineitem JOIN t_features ON l_orderkey = id GROUP BY ALL"""))
def close_dates(spark, root):
    lines = table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "MM/dd/yyyy").alias("shipped")
    )
    ordered = shapes.rounds(spark, root).select(F.col("id").alias("l_orderkey"), "date")
    close = dates.dates_are_close(F.col("date"), F.col("shipped"), 90).alias("is_close")
    return spread(lines, "l_orderkey").join(ordered, "l_orderkey").groupBy("l_orderkey", "l_linenumber", close).agg(
        F.count("*").alias("lines")
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice > 0 AND l_quantity > 0 AND
             abs(l_extendedprice - l_quantity * 1500) / greatest(l_extendedprice, l_quantity * 1500) <= 0.1
             AS is_similar, count(*) AS lines
    FROM lineitem GROUP BY ALL""")
def similar_amounts(spark, root):
    similar = numbers.amounts_are_similar(F.col("l_extendedprice"), F.col("l_quantity") * 1500, 0.1)
    return table(spark, root, "lineitem").groupBy(
        "l_orderkey", "l_linenumber", similar.alias("is_similar")
    ).agg(F.count("*").alias("lines"))


@query(sql("""
    SELECT id, other, norm = trim(lower(other)) OR list_has_any(keywords, list_filter(['seed',
             'series a', 'series b', 'series c', 'series d', 'series e', 'series f', 'series g',
             'series h'], lambda k: contains(lower(other), k))) AS is_match, count(*) AS lines
    FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'SEED round' WHEN 'R' THEN 'Series Alpha'
                 ELSE 'form d filing' END AS other
          FROM lineitem JOIN t_features ON l_orderkey = id) GROUP BY ALL"""))
def matching_round_names(spark, root):
    other = F.expr(
        "CASE l_returnflag WHEN 'A' THEN 'SEED round' WHEN 'R' THEN 'Series Alpha' ELSE 'form d filing' END"
    )
    lines = table(spark, root, "lineitem").select(F.col("l_orderkey").alias("id"), other.alias("other"))
    named = lines.join(shapes.rounds(spark, root).select("id", "round_name"), "id")
    match = text.round_names_match(F.col("round_name"), F.col("other")).alias("is_match")
    return named.groupBy("id", "other", match).agg(F.count("*").alias("lines"))


@query(sql("SELECT id, facts AS completeness FROM t_features"))
def round_completeness(spark, root):
    return shapes.rounds(spark, root).select("id", numbers.completeness(
        F.col("amount_raised_usd"), F.col("pre_money_valuation_usd"),
        F.col("post_money_valuation_usd"), F.col("lead_investor"),
    ).alias("completeness"))


@query("""
    SELECT doc_id, contains(lower(text), lower(source)) OR contains(lower(source), lower(text)) AS held
    FROM documents""")
def contained_names(spark, root):
    return table(spark, root, "documents").select(
        "doc_id", text.contains_either_way(F.col("text"), F.col("source")).alias("held")
    )


@query("""
    SELECT o_orderkey, CASE WHEN length(n) < 10 THEN lpad(n, 10, '0') ELSE n END AS padded,
           CAST(n AS BIGINT) AS unpadded
    FROM (SELECT o_orderkey, CAST(o_orderkey * 1000003 AS VARCHAR) AS n FROM orders)""")
def padded_ids(spark, root):
    number = F.col("o_orderkey") * 1000003
    return table(spark, root, "orders").select("o_orderkey", numbers.padded_cik(number).alias("padded")).withColumn(
        "unpadded", numbers.unpadded_cik(F.col("padded"))
    )


_MESSY = """CASE event_type WHEN 'error' THEN 'Indefinite' WHEN 'click' THEN concat(' ', value, ' ')
    WHEN 'view' THEN concat(user_id, '_000') WHEN 'purchase' THEN concat(value, 'd')
    ELSE concat('-', value, 'e2') END"""


@query(f"""
    SELECT event_id, CASE WHEN regexp_matches(trim(messy),
             '^[+-]?([0-9](_?[0-9])*\\.?([0-9](_?[0-9])*)?|\\.[0-9](_?[0-9])*)([eE][+-]?[0-9]+)?$')
           THEN CAST(replace(trim(messy), '_', '') AS DOUBLE) END AS number
    FROM (SELECT event_id, {_MESSY} AS messy FROM events)""")
def numbers_from_text(spark, root):
    messy = table(spark, root, "events").selectExpr("event_id", f"{_MESSY} AS messy")
    return messy.select("event_id", numbers.number_from_text(F.col("messy")).alias("number"))


@query("""
    SELECT doc_id, CASE WHEN length(text) > 490 THEN substring(text, 1, 490) || '...' ELSE text END AS title
    FROM documents""")
def truncated_titles(spark, root):
    return table(spark, root, "documents").select(
        "doc_id", text.truncated_title(F.col("text")).alias("title")
    )


@query(sql("SELECT o_orderkey, slice FROM t_slices"))
def response_slices(spark, root):
    return shapes.responses(spark, root).select(
        "o_orderkey", search.array_slice(F.col("response")).alias("slice")
    )


@query(sql("""
    SELECT company_id, company_name, round_name, date, TRY_CAST(amount_raised_usd AS DOUBLE) AS amount,
           TRY_CAST(pre_money_valuation_usd AS DOUBLE) AS pre_money, lead_investor, source_url
    FROM t_records"""))
def response_records(spark, root):
    return records.response_records(shapes.responses(spark, root)).select(
        "company_id", "company_name", "round_name", "date", F.col("amount_raised_usd").alias("amount"),
        F.col("pre_money_valuation_usd").alias("pre_money"), "lead_investor", "source_url",
    )


@query(sql("""
    SELECT o_orderkey, response FROM t_slices WHERE response <> ''
      AND (slice IS NULL OR NOT json_valid(slice))"""))
def rejected_responses(spark, root):
    return records.rejected_responses(shapes.responses(spark, root)).select("o_orderkey", "response")


@query(sql("SELECT o_orderkey, form, filing_date, accession_number FROM t_filings"))
def zipped_filings(spark, root):
    return filing_source.filings(shapes.filing_indexes(spark, root)).drop("company_id")


@query(sql("""
    SELECT o_orderkey, filing_date, accession_number FROM t_filings
    WHERE form = 'D' AND accession_number <> ''"""))
def offering_filings(spark, root):
    filed = filing_source.filings(shapes.filing_indexes(spark, root))
    return filing_source.offering_filings(filed).drop("company_id", "form")


@query(sql("""
    SELECT o_orderkey, is_offering, CASE WHEN is_offering THEN read_amount END AS amount
    FROM t_offerings UNION ALL SELECT o_orderkey, is_offering, amount FROM t_nested"""))
def filing_offerings(spark, root):
    from capledger.functions.filings import offering

    documents = shapes.filing_documents(spark, root).select("o_orderkey", "document").unionByName(shapes.nested_documents(spark, root))
    return documents.select("o_orderkey", F.inline(F.array(offering(F.col("document")))))


@query("""
    SELECT o_orderkey, 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/'
             || replace('000-24-' || o_orderkey, '-', '') || '/primary_doc.xml' AS url
    FROM orders""")
def archive_urls(spark, root):
    from capledger.functions.filings import archive_url

    return shapes.filing_documents(spark, root).select(
        "o_orderkey", archive_url(F.col("cik"), F.col("accession_number")).alias("url")
    )


@query(sql("""
    SELECT o_orderkey AS round_id, trim(name) AS name
    FROM (SELECT o_orderkey, unnest(all_investors) AS name FROM t_records) WHERE trim(name) <> ''"""))
def exploded_investors(spark, root):
    answers = shapes.responses(spark, root).withColumn("company_id", F.col("o_orderkey"))
    return entities.exploded_investors(
        records.response_records(answers).withColumnRenamed("company_id", "id")
    )


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS events FROM events GROUP BY ALL")
def events_per_utc_day(spark, root):
    day = dates.utc_day(F.col("ts")).alias("day")
    return table(spark, root, "events").groupBy(day).agg(F.count("*").alias("events"))


_TEMPLATES = ", ".join(
    f"({i}, '{t}')" for i, t in enumerate(search.QUERY_TEMPLATES, 1)
)


@query(sql(f"""
    SELECT id AS company_id, CAST(n AS INT) AS query_no, replace(template, '{{company}}', name) AS query
    FROM t_companies, (VALUES {_TEMPLATES}) AS t(n, template)"""))
def search_queries(spark, root):
    return search_source.company_queries(shapes.companies(spark, root))


@query(sql("SELECT company_id, query_no, rank, title, url, snippet FROM t_hits"))
def search_hits(spark, root):
    return search_source.search_hits(shapes.landed_hits(spark, root))


def _prompt_sql(part: str) -> str:
    return "'" + part.replace("'", "''").replace("{company}", "' || name || '") + "'"


def _echo(prompts):
    """A stand-in for a model: an answer that depends on the prompt alone."""
    return [json.dumps([{"round_name": "Echo", "notes": str(p.count("--- Result "))}]) for p in prompts]


@query(sql("""
    SELECT company_id, 'Echo' AS round_name, CAST(count(*) AS VARCHAR) AS notes FROM t_hits JOIN t_companies ON company_id = id GROUP BY company_id"""))
def answered_prompts(spark, root):
    """Prompts through a user's function and back to round records: the answers count the hits they were shown."""
    hits = search_source.search_hits(shapes.landed_hits(spark, root)).withColumns({"title": F.lit("t"), "snippet": F.lit("s")})
    prompts = search_source.company_prompts(hits, shapes.companies(spark, root))
    answers = search_source.answer_prompts(prompts, _echo).withColumn("company_name", F.lit("c"))
    return records.response_records(answers).select("company_id", "round_name", "notes")


@query(sql(f"""
    SELECT company_id, {_prompt_sql(search.PROMPT_HEAD)} || blocks || {_prompt_sql(search.PROMPT_TAIL)} AS prompt
    FROM (SELECT company_id, string_agg(chr(10) || chr(10) || '--- Result ' || n || ' ---' || chr(10)
              || 'Title: ' || title || chr(10) || 'URL: ' || url || chr(10) || 'Snippet: ' || snippet
              || chr(10), '' ORDER BY n) AS blocks
          FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY query_no, rank) AS n FROM t_hits)
          GROUP BY company_id) JOIN t_companies ON company_id = id"""))
def extraction_prompts(spark, root):
    hits = search_source.search_hits(shapes.landed_hits(spark, root))
    return search_source.company_prompts(hits, shapes.companies(spark, root))


@query("""
    SELECT doc_id, regexp_replace(text, '([A-Za-z0-9_]{1,3})[A-Za-z0-9_.+-]*@', '\\1***@', 'g') AS masked
    FROM documents""")
def masked_document_emails(spark, root):
    return table(spark, root, "documents").select(
        "doc_id", text.masked_emails(F.col("text")).alias("masked")
    )


@query("""
    SELECT conv_id, turn, regexp_replace(text, '([A-Za-z0-9_]{1,3})[A-Za-z0-9_.+-]*@', '\\1***@', 'g') AS masked
    FROM conversations""")
def masked_conversation_emails(spark, root):
    return table(spark, root, "conversations").select(
        "conv_id", "turn", text.masked_emails(F.col("text")).alias("masked")
    )


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'Agent ' || substring(local, 1, 3) || '***@' || c_mktsegment || '.example'
             WHEN c_acctbal > 0 THEN 'Agent a@b@c' ELSE c_name END AS account
    FROM (SELECT *, 'user' || c_custkey AS local FROM customer)""")
def masked_accounts(spark, root):
    account = F.expr("""CASE WHEN c_acctbal > 5000
        THEN concat('Agent  user', c_custkey, '@', c_mktsegment, '.example extra words')
        WHEN c_acctbal > 0 THEN 'Agent a@b@c' ELSE c_name END""")
    return table(spark, root, "customer").select(
        "c_custkey", text.masked_account(account).alias("account")
    )


@query("""
    SELECT c_custkey, 'postgresql://user' || c_custkey || ':***@host' || c_nationkey || ':5432/db_'
             || c_mktsegment || '?ssl=on' AS masked,
           'host' || c_nationkey || ':5432' AS host, 'db_' || c_mktsegment AS database
    FROM customer""")
def connection_url_parts(spark, root):
    url = F.expr("""concat('postgresql://user', c_custkey, ':p:w', c_acctbal, '@host', c_nationkey,
        ':5432/db_', c_mktsegment, '?ssl=on')""")
    return table(spark, root, "customer").select(
        "c_custkey", text.masked_url_password(url).alias("masked"), text.url_host(url).alias("host"),
        text.url_database(url).alias("database"),
    )


@query("""
    SELECT n_name, coalesce(round(100.0 * sum(in_debt) / nullif(sum(big), 0), 6), 0) AS percent,
           CAST(round(count(c_custkey) * 0.00045, 9) AS DOUBLE) AS traffic_gb, count(c_custkey) * 0.00045 > 9.5 AS warns
    FROM nation LEFT JOIN (SELECT *, CAST(c_acctbal < 0 AS INT) AS in_debt,
                                  CAST(c_mktsegment = 'BUILDING' AS INT) AS big FROM customer)
      ON n_nationkey = c_nationkey
    GROUP BY n_name""")
def percent_and_traffic(spark, root):
    counted = table(spark, root, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"),
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"),
    )
    gb = numbers.estimated_traffic_gb(F.coalesce("n", F.lit(0)))
    return table(spark, root, "nation").join(counted, "n_nationkey", "left").select(
        "n_name",
        F.round(numbers.percent(F.col("in_debt"), F.col("building")), 6).alias("percent"),
        F.round(gb, 9).alias("traffic_gb"), (gb > numbers.TRAFFIC_WARNING_GB).alias("warns"),
    )
