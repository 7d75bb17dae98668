"""The library's tables and landed records, derived from the benchmark tables.

Each shape exists twice with the same arithmetic: as a DataFrame for the queries and as a
common table expression for the SQL they are compared with.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from capledger.functions.filings import OFFERING_NAMESPACE


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def companies(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name",
        "CASE WHEN c_custkey % 3 <> 0 THEN lpad(CAST(c_custkey AS STRING), 10, '0') END AS cik",
        "CAST(NULL AS STRING) AS official_name",
        "TIMESTAMP '2024-01-01 00:00:00' AS created_at", "TIMESTAMP '2024-01-01 00:00:00' AS updated_at",
    )


def rounds(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").selectExpr(
        "o_orderkey AS id", "o_custkey AS company_id",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'Seed' WHEN '2-HIGH' THEN 'Pre-Seed'
           WHEN '3-MEDIUM' THEN ' series a ' WHEN '4-NOT SPECIFIED' THEN 'Series B'
           ELSE 'Form D Filing' END AS round_name""",
        """CASE o_orderkey % 6 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
           WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM') WHEN 2 THEN date_format(o_orderdate, 'yyyy')
           WHEN 3 THEN date_format(o_orderdate, 'MM/dd/yyyy')
           WHEN 4 THEN date_format(o_orderdate, 'dd/MM/yyyy') END AS date""",
        "CASE o_orderkey % 7 WHEN 0 THEN 0D WHEN 1 THEN NULL ELSE o_totalprice END AS amount_raised_usd",
        "CASE WHEN o_orderkey % 7 > 3 THEN 4 * o_totalprice END AS pre_money_valuation_usd",
        "CAST(NULL AS DOUBLE) AS post_money_valuation_usd",
        "CAST(NULL AS STRING) AS lead_investor",
        "CASE WHEN o_orderstatus = 'F' THEN 'SEC_FORM_D' ELSE 'WEB_SEARCH' END AS source_type",
        "CASE o_orderstatus WHEN 'F' THEN 'HIGH' WHEN 'O' THEN 'MEDIUM' ELSE 'LOW' END AS confidence_score",
        """array(concat('https://deals.example/', o_orderkey),
                 concat('https://news.example/', o_custkey)) AS source_urls""",
        "CASE WHEN o_orderstatus <> 'O' THEN concat('Seen, \"', o_orderpriority, '\"') END AS notes",
        "CAST(NULL AS STRING) AS raw_data",
        "false AS is_duplicate", "CAST(NULL AS BIGINT) AS duplicate_of_id",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at", "CAST(o_orderdate AS TIMESTAMP) AS updated_at",
    )


def investors(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "CAST(NULL AS STRING) AS investor_type",
        "TIMESTAMP '2024-01-01 00:00:00' AS created_at", "TIMESTAMP '2024-01-01 00:00:00' AS updated_at",
    )


def links(spark: SparkSession, root: str) -> DataFrame:
    """Round-investor pairs with repeats, one per line."""
    return table(spark, root, "lineitem").selectExpr("l_orderkey AS round_id", "l_suppkey AS investor_id")


def sources(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "lineitem").selectExpr(
        "l_orderkey AS round_id", "'WEB_SEARCH' AS source_type",
        "concat('https://deals.example/', l_orderkey, '/', l_linenumber) AS url",
    )


def status(spark: SparkSession, root: str) -> DataFrame:
    """Companies with a negative balance have no status row."""
    return table(spark, root, "customer").where("c_acctbal >= 0").selectExpr(
        "c_custkey AS id", "c_custkey AS company_id",
        "c_nationkey % 2 = 0 AS stage1_resolved",
        "CAST(NULL AS TIMESTAMP) AS stage1_completed_at",
        "c_mktsegment <> 'BUILDING' AS stage2_sec_collected",
        "timestamp_seconds(1704067200 + c_custkey % 1000) AS stage2_completed_at",
        "c_nationkey AS stage2_rounds_found",
        "c_acctbal > 3000 AS stage3_search_extracted",
        "CAST(NULL AS TIMESTAMP) AS stage3_completed_at",
        "CAST(c_acctbal / 100 AS INT) AS stage3_rounds_found",
        "c_nationkey % 5 = 0 AS stage4_merged",
        "CAST(NULL AS TIMESTAMP) AS stage4_completed_at",
        "0 AS stage4_unique_rounds", "false AS has_errors", "CAST(NULL AS STRING) AS error_message",
        "0 AS retry_count",
        "TIMESTAMP '2024-01-01 00:00:00' AS created_at", "TIMESTAMP '2024-01-01 00:00:00' AS updated_at",
    )


CALL_COLUMNS = (
    "event_id", "CAST(ts AS TIMESTAMP) AS ts", "event_type AS provider_name",
    "concat('model-', user_id % 3) AS model_name", "user_id AS account",
    "CAST(get_json_object(props, '$.k') AS INT) % 5 <> 0 AS success",
    "CAST(get_json_object(props, '$.k') AS INT) % 10 = 0 AS rate_limited",
    "value AS latency_ms",
    "CAST(get_json_object(props, '$.k') AS INT) AS input_tokens",
    "CAST(get_json_object(props, '$.k') AS INT) * 2 AS output_tokens",
)


def calls(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").selectExpr(*CALL_COLUMNS)


def call_stream(spark: SparkSession, root: str) -> DataFrame:
    """The call log as a stream over the landed file."""
    schema = table(spark, root, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(root)
        .selectExpr(*CALL_COLUMNS)
    )


def providers(spark: SparkSession, root: str) -> DataFrame:
    """One provider per kind of call seen; its limits follow from how often it is seen."""
    return (
        table(spark, root, "events").groupBy("event_type")
        .agg(F.count("*").alias("n"), F.min("user_id").alias("low"), F.max("value").alias("top"))
        .selectExpr(
            "event_type AS name", "CAST(n % 7 AS INT) AS priority",
            "CAST(n % 11 + 2 AS INT) AS rate_limit_rpm",
            "event_type <> 'error' AS enabled", "top > 0 AS has_api_key",
        )
    )


def responses(spark: SparkSession, root: str) -> DataFrame:
    """Model answers, one per order: prose around an array, a bare array, or nothing readable."""
    one = """concat('{"round_name": "Series B", "date": "', date_format(o_orderdate, 'yyyy-MM'),
        '", "amount_raised_usd": ', CAST(o_totalprice AS STRING),
        ', "pre_money_valuation_usd": "n/a", "lead_investor": null, "all_investors": [" Fund ',
        o_custkey, '", "", "Angel ', o_orderkey % 10, '"], "source_url": "https://deals.example/',
        o_orderkey, '"}')"""
    two = """'{"round_name": "Seed", "source_url": ""}'"""
    return table(spark, root, "orders").selectExpr(
        "o_orderkey", "o_custkey AS company_id", "concat('Company ', o_custkey) AS company_name",
        f"""CASE WHEN o_orderstatus = 'F' THEN concat('Here you go:\\n[', {one}, ', ', {two}, ']\\nDone.')
            WHEN o_orderstatus = 'O' THEN concat('  [', {one}, ']  ')
            WHEN o_orderpriority = '1-URGENT' THEN 'No rounds found.'
            WHEN o_orderpriority = '2-HIGH' THEN 'Empty: []'
            ELSE concat('[{{\"round_name\": ', o_orderkey, ' broken]') END AS response""",
    )


def filing_indexes(spark: SparkSession, root: str) -> DataFrame:
    """A filings index per order: unequal array lengths, other forms, missing parts."""
    return table(spark, root, "orders").selectExpr(
        "o_orderkey", "o_custkey AS company_id",
        """CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '{"filings": {}}'
        WHEN o_orderstatus = 'P' THEN concat('{"filings": {"recent": {"form": ["D", "10-K"],
            "accessionNumber": ["", "A-', o_orderkey, '"]}}}')
        ELSE concat('{"filings": {"recent": {"form": ["D", "D/A", "D"], "filingDate": ["',
            date_format(o_orderdate, 'yyyy-MM-dd'), '", "2001-02-03"], "accessionNumber": ["000-24-',
            o_orderkey, '", "A-1", "B-', o_orderkey, '"]}}}') END AS payload""",
    )


def filing_documents(spark: SparkSession, root: str) -> DataFrame:
    """An offering document per order; some are malformed, foreign or without an amount."""
    return table(spark, root, "orders").selectExpr(
        "o_orderkey", "o_custkey AS company_id", "concat('Company ', o_custkey) AS company_name",
        "lpad(CAST(o_custkey AS STRING), 10, '0') AS cik",
        "CASE WHEN o_orderstatus <> 'P' THEN date_format(o_orderdate, 'yyyy-MM-dd') END AS filing_date",
        "concat('000-24-', o_orderkey) AS accession_number",
        f"""concat('<?xml version="1.0"?>\\n<edgarSubmission xmlns="',
            CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'urn:other' ELSE '{OFFERING_NAMESPACE}' END,
            '"><issuer>', o_custkey, '</issuer>',
            CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE concat('<offeringData><sales>',
                CASE WHEN o_orderstatus = 'F' THEN concat('<totalOfferingAmount>',
                    CAST(o_totalprice AS STRING), '</totalOfferingAmount>')
                WHEN o_orderstatus = 'O' THEN '<totalOfferingAmount>Indefinite</totalOfferingAmount>'
                ELSE '<other/>' END, '</sales></offeringData>') END,
            CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN '<open>' ELSE '' END,
            '</edgarSubmission>') AS document""",
    )


# How the offering stands in a document: nested deeply, under bound, unused, re-bound and unbound prefixes, as the root,
# twice, in a comment, beside foreign data. Each with what must be read: an offering or none, and its amount.
NESTED = (
    ('<e xmlns="{ns}"><a><b><offeringData><x><y><totalOfferingAmount>{n}</totalOfferingAmount></y></x></offeringData></b></a></e>', True, True),
    ('<s:e xmlns:s="{ns}"><a><s:offeringData><s:totalOfferingAmount k="1 > 0"> {n} </s:totalOfferingAmount></s:offeringData></a></s:e>', True, True),
    ('<e xmlns:s="{ns}"><offeringData><totalOfferingAmount>{n}</totalOfferingAmount></offeringData></e>', False, False),
    ('<e xmlns="{ns}"><p xmlns="urn:b"><offeringData><totalOfferingAmount>1</totalOfferingAmount></offeringData></p><offeringData><totalOfferingAmount xmlns="urn:b">2</totalOfferingAmount><totalOfferingAmount>{n}</totalOfferingAmount></offeringData></e>', True, True),
    ('<s:e xmlns:s="{ns}"><s:p xmlns:s="urn:b"><s:offeringData/></s:p></s:e>', False, False),
    ('<e xmlns="{ns}"><q:offeringData><totalOfferingAmount>{n}</totalOfferingAmount></q:offeringData></e>', False, False),
    ('<offeringData xmlns="{ns}"><totalOfferingAmount>{n}</totalOfferingAmount></offeringData>', False, False),
    ('<e xmlns="{ns}"><!-- <offeringData/> --><offeringData><sales/></offeringData><offeringData><totalOfferingAmount>{n}</totalOfferingAmount></offeringData></e>', True, False),
    ('<e xmlns="{ns}"><offeringData><totalOfferingAmount><![CDATA[{n}]]></totalOfferingAmount></offeringData></e>', True, True),
    ('<e xmlns="urn:b"><f xmlns="{ns}"/><offeringData><totalOfferingAmount>{n}</totalOfferingAmount></offeringData></e>', False, False),
    ('<e xmlns="{ns}"><offeringData><totalOfferingAmount>{n}<u>7</u>8</totalOfferingAmount></offeringData></e>', True, True),
    ('<e xmlns="{ns}"><offeringData t:k="1"><totalOfferingAmount>{n}</totalOfferingAmount></offeringData></e>', False, False),
    ("<e xmlns = '{ns}' note='&lt;offeringData/> x:y=\"1\"'><offeringData/></e>", True, False),
)


def nested_documents(spark: SparkSession, root: str) -> DataFrame:
    """A document per order in one of the forms above; ids are negative."""
    texts = ", ".join("'" + t.replace("{ns}", OFFERING_NAMESPACE).replace("'", "\\'") + "'" for t, _, _ in NESTED)
    return table(spark, root, "orders").selectExpr(
        "-o_orderkey AS o_orderkey",
        f"replace(element_at(array({texts}), CAST(o_orderkey % {len(NESTED)} AS INT) + 1), '{{n}}', CAST(o_custkey AS STRING)) AS document",
    )


def landed_hits(spark: SparkSession, root: str) -> DataFrame:
    """Five hits per company and query from the crawled pages; every sixth has no title."""
    return table(spark, root, "pages").selectExpr(
        "page_id DIV 10 AS company_id", "CAST(page_id % 2 AS INT) + 1 AS query_no",
        "CAST(page_id DIV 2 % 5 AS INT) + 1 AS rank",
        "CASE WHEN page_id % 6 <> 0 THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END AS title",
        "CASE WHEN page_id % 10 < 6 THEN 'https://deals.example/shared' ELSE url END AS href",
        "html AS body",
    )


# The same shapes for the SQL side.
SQL = {
    "t_companies": """
        SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_custkey % 3 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS cik
        FROM customer""",
    "t_rounds": """
        SELECT o_orderkey AS id, o_custkey AS company_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Seed' WHEN '2-HIGH' THEN 'Pre-Seed'
                 WHEN '3-MEDIUM' THEN ' series a ' WHEN '4-NOT SPECIFIED' THEN 'Series B'
                 ELSE 'Form D Filing' END AS round_name,
               CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                 WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y')
                 WHEN 3 THEN strftime(o_orderdate, '%m/%d/%Y')
                 WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y') END AS date,
               CASE o_orderkey % 7 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE o_totalprice END
                 AS amount_raised_usd,
               CASE WHEN o_orderkey % 7 > 3 THEN 4 * o_totalprice END AS pre_money_valuation_usd,
               CAST(NULL AS DOUBLE) AS post_money_valuation_usd,
               CAST(NULL AS VARCHAR) AS lead_investor,
               CASE WHEN o_orderstatus = 'F' THEN 'SEC_FORM_D' ELSE 'WEB_SEARCH' END AS source_type,
               CASE o_orderstatus WHEN 'F' THEN 'HIGH' WHEN 'O' THEN 'MEDIUM' ELSE 'LOW' END
                 AS confidence_score,
               'https://deals.example/' || o_orderkey || ', https://news.example/' || o_custkey
                 AS source_urls,
               CASE WHEN o_orderstatus <> 'O' THEN 'Seen, "' || o_orderpriority || '"' END AS notes
        FROM orders""",
    "t_features": """
        SELECT *, CAST(try_strptime(date, ['%Y-%m-%d', '%Y-%m', '%Y', '%m/%d/%Y', '%d/%m/%Y']) AS DATE)
                 AS day,
               trim(lower(round_name)) AS norm,
               list_filter(['seed', 'series a', 'series b', 'series c', 'series d', 'series e',
                 'series f', 'series g', 'series h'], lambda k: contains(trim(lower(round_name)), k)) AS keywords,
               CASE WHEN confidence_score = 'HIGH' THEN 1 ELSE 0 END AS is_high,
               CAST(coalesce(amount_raised_usd, 0) <> 0 AS INT)
                 + CAST(coalesce(pre_money_valuation_usd, 0) <> 0 AS INT)
                 + CAST(coalesce(post_money_valuation_usd, 0) <> 0 AS INT)
                 + CAST(coalesce(lead_investor, '') <> '' AS INT) AS facts
        FROM t_rounds""",
    "t_pairs": """
        SELECT a.company_id,
               CASE WHEN a.is_high > b.is_high OR (a.is_high = b.is_high AND a.facts >= b.facts)
                    THEN b.id ELSE a.id END AS loser_id,
               CASE WHEN a.is_high > b.is_high OR (a.is_high = b.is_high AND a.facts >= b.facts)
                    THEN a.id ELSE b.id END AS winner_id,
               a.norm = b.norm AS same_name, list_has_any(a.keywords, b.keywords) AS same_keyword,
               coalesce(a.amount_raised_usd > 0 AND b.amount_raised_usd > 0
                 AND abs(a.amount_raised_usd - b.amount_raised_usd)
                   / greatest(a.amount_raised_usd, b.amount_raised_usd) <= 0.1, false) AS same_amount
        FROM t_features a JOIN t_features b
          ON a.company_id = b.company_id AND a.id < b.id AND abs(date_diff('day', a.day, b.day)) <= 90""",
    "t_matches": "SELECT * FROM t_pairs WHERE same_name OR same_keyword OR same_amount",
    "t_losers": "SELECT loser_id AS round_id, max(winner_id) AS winner_id FROM t_matches GROUP BY loser_id",
    "t_merged": """
        SELECT r.*, l.winner_id IS NOT NULL AS is_duplicate, l.winner_id AS duplicate_of_id
        FROM t_rounds r LEFT JOIN t_losers l ON r.id = l.round_id""",
    "t_investors": "SELECT s_suppkey AS id, s_name AS name FROM supplier",
    "t_links": "SELECT l_orderkey AS round_id, l_suppkey AS investor_id FROM lineitem",
    "t_status": """
        SELECT c_custkey AS company_id, c_nationkey % 2 = 0 AS stage1_resolved,
               c_mktsegment <> 'BUILDING' AS stage2_sec_collected,
               c_custkey % 1000 AS stage2_second, c_nationkey AS stage2_rounds_found,
               c_acctbal > 3000 AS stage3_search_extracted,
               CAST(trunc(c_acctbal / 100) AS INT) AS stage3_rounds_found,
               c_nationkey % 5 = 0 AS stage4_merged
        FROM customer WHERE c_acctbal >= 0""",
    "t_calls": """
        SELECT event_id, ts, event_type AS provider_name, 'model-' || (user_id % 3) AS model_name,
               user_id AS account, k % 5 <> 0 AS success, k % 10 = 0 AS rate_limited,
               value AS latency_ms, k AS input_tokens, k * 2 AS output_tokens
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "t_providers": """
        SELECT event_type AS name, CAST(count(*) % 7 AS INT) AS priority,
               CAST(count(*) % 11 + 2 AS INT) AS rate_limit_rpm,
               event_type <> 'error' AS enabled, max(value) > 0 AS has_api_key
        FROM events GROUP BY event_type""",
    "t_responses": """
        SELECT o_orderkey, o_custkey AS company_id, 'Company ' || o_custkey AS company_name,
               CASE WHEN o_orderstatus = 'F' THEN 'Here you go:' || chr(10) || '[' || one || ', ' || two
                      || ']' || chr(10) || 'Done.'
                 WHEN o_orderstatus = 'O' THEN '  [' || one || ']  '
                 WHEN o_orderpriority = '1-URGENT' THEN 'No rounds found.'
                 WHEN o_orderpriority = '2-HIGH' THEN 'Empty: []'
                 ELSE '[{"round_name": ' || o_orderkey || ' broken]' END AS response
        FROM (SELECT *, '{"round_name": "Series B", "date": "' || strftime(o_orderdate, '%Y-%m')
                || '", "amount_raised_usd": ' || CAST(o_totalprice AS VARCHAR)
                || ', "pre_money_valuation_usd": "n/a", "lead_investor": null, "all_investors": [" Fund '
                || o_custkey || '", "", "Angel ' || (o_orderkey % 10)
                || '"], "source_url": "https://deals.example/' || o_orderkey || '"}' AS one,
                '{"round_name": "Seed", "source_url": ""}' AS two
              FROM orders)""",
    "t_slices": """
        SELECT *, nullif(regexp_extract(trim(response), '\\[.*\\]', 0, 's'), '') AS slice
        FROM t_responses""",
    "t_records": """
        SELECT o_orderkey, company_id, company_name, r.*
        FROM (SELECT *, unnest(from_json(CASE WHEN json_valid(slice) THEN slice ELSE '[]' END,
                '[{"round_name": "VARCHAR", "date": "VARCHAR", "amount_raised_usd": "VARCHAR",
                   "pre_money_valuation_usd": "VARCHAR", "lead_investor": "VARCHAR",
                   "all_investors": ["VARCHAR"], "source_url": "VARCHAR"}]')) AS r
              FROM t_slices WHERE slice IS NOT NULL)""",
    "t_indexes": """
        SELECT o_orderkey, o_custkey AS company_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '{"filings": {}}'
                 WHEN o_orderstatus = 'P' THEN '{"filings": {"recent": {"form": ["D", "10-K"],
                   "accessionNumber": ["", "A-' || o_orderkey || '"]}}}'
                 ELSE '{"filings": {"recent": {"form": ["D", "D/A", "D"], "filingDate": ["'
                   || strftime(o_orderdate, '%Y-%m-%d') || '", "2001-02-03"], "accessionNumber": ["000-24-'
                   || o_orderkey || '", "A-1", "B-' || o_orderkey || '"]}}}' END AS payload
        FROM orders""",
    "t_filings": """
        SELECT o_orderkey, company_id, z[1] AS form, z[2] AS filing_date, z[3] AS accession_number
        FROM (SELECT *, unnest(list_zip(
                CAST(json_extract(payload, '$.filings.recent.form') AS VARCHAR[]),
                coalesce(CAST(json_extract(payload, '$.filings.recent.filingDate') AS VARCHAR[]), []),
                coalesce(CAST(json_extract(payload, '$.filings.recent.accessionNumber') AS VARCHAR[]), [])
              )) AS z FROM t_indexes WHERE json_extract(payload, '$.filings.recent') IS NOT NULL)""",
    "t_documents": f"""
        SELECT o_orderkey, o_custkey AS company_id, 'Company ' || o_custkey AS company_name,
               lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
               CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS filing_date,
               '000-24-' || o_orderkey AS accession_number,
               '<edgarSubmission xmlns="' || CASE WHEN o_orderpriority = '4-NOT SPECIFIED'
                   THEN 'urn:other' ELSE '{OFFERING_NAMESPACE}' END
                 || '"><issuer>' || o_custkey || '</issuer>'
                 || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '<offeringData><sales>'
                   || CASE WHEN o_orderstatus = 'F' THEN '<totalOfferingAmount>'
                        || CAST(o_totalprice AS VARCHAR) || '</totalOfferingAmount>'
                      WHEN o_orderstatus = 'O' THEN '<totalOfferingAmount>Indefinite</totalOfferingAmount>'
                      ELSE '<other/>' END || '</sales></offeringData>' END
                 || CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN '<open>' ELSE '' END
                 || '</edgarSubmission>' AS document
        FROM orders""",
    "t_offerings": f"""
        SELECT *, contains(document, '<offeringData>') AND NOT contains(document, '<open>')
                 AND contains(document, 'xmlns="{OFFERING_NAMESPACE}"') AS is_offering,
               TRY_CAST(regexp_extract(document, '<totalOfferingAmount>([^<]*)<', 1) AS DOUBLE) AS read_amount
        FROM t_documents""",
    "t_nested": f"""
        SELECT -o_orderkey AS o_orderkey, [{", ".join(str(found).lower() for _, found, _ in NESTED)}][o_orderkey % {len(NESTED)} + 1] AS is_offering,
               CASE WHEN [{", ".join(str(read).lower() for _, _, read in NESTED)}][o_orderkey % {len(NESTED)} + 1] THEN CAST(o_custkey AS DOUBLE) END AS amount
        FROM orders""",
    "t_landed": """
        SELECT page_id // 10 AS company_id, CAST(page_id % 2 AS INT) + 1 AS query_no,
               CAST(page_id // 2 % 5 AS INT) + 1 AS rank,
               coalesce(CASE WHEN page_id % 6 <> 0
                 THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END, '') AS title,
               CASE WHEN page_id % 10 < 6 THEN 'https://deals.example/shared' ELSE url END AS url,
               html AS snippet
        FROM pages""",
    "t_hits": """
        SELECT * EXCLUDE (rank, place), place AS rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY company_id, query_no
                   ORDER BY rank, url, title, snippet) AS INT) AS place FROM t_landed)
        WHERE place <= 4""",
}

_NEEDS = {
    "t_features": ["t_rounds"], "t_pairs": ["t_features"], "t_matches": ["t_pairs"],
    "t_losers": ["t_matches"], "t_merged": ["t_losers", "t_rounds"], "t_slices": ["t_responses"],
    "t_records": ["t_slices"], "t_filings": ["t_indexes"], "t_offerings": ["t_documents"],
    "t_hits": ["t_landed"],
}


@cache
def _closure(name: str) -> tuple[str, ...]:
    ordered: list[str] = []
    for needed in _NEEDS.get(name, []):
        ordered += [n for n in _closure(needed) if n not in ordered]
    return (*ordered, name)


def sql(body: str, replace: dict[str, str] | None = None) -> str:
    """``body`` with the shapes it names put in front as common table expressions."""
    texts = SQL | (replace or {})
    wanted: list[str] = []
    for name in SQL:
        if name in body:
            wanted += [n for n in _closure(name) if n not in wanted]
    if not wanted:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({texts[n]})" for n in wanted) + "\n" + body
