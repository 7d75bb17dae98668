"""Queries over companies, rounds, investors, sources and status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from capledger.checks import shapes
from capledger.checks.registry import query
from capledger.checks.shapes import sql, table
from capledger.operators import dedup, entities, quality, ranking, reporting, resolve
from capledger.operators import rounds as records, status as stage_status
from capledger.plans import stages
from capledger.session import spread
from capledger.sources import filings as filing_source, search as search_source


def _now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


EXACT = "decimal(18,2)"


def _merged(spark, root) -> DataFrame:
    return dedup.deduplicate(shapes.rounds(spark, root))


@query(sql("SELECT id, name, cik, official_name FROM (SELECT *, NULL::VARCHAR AS official_name FROM t_companies) "
           "WHERE name = 'Customer#000000042'"))
def company_by_name(spark, root):
    found = entities.company_by_name(shapes.companies(spark, root), "Customer#000000042")
    return found.select("id", "name", "cik", "official_name")


@query(sql("SELECT id, date, amount_raised_usd FROM t_merged WHERE company_id = 7 AND NOT is_duplicate"))
def rounds_of_company(spark, root):
    return records.rounds_for_company(_merged(spark, root), 7).select("id", "date", "amount_raised_usd")


@query(sql("SELECT id, company_id, amount_raised_usd, confidence_score FROM t_merged WHERE NOT is_duplicate"))
def non_duplicate_rounds(spark, root):
    return records.non_duplicates(_merged(spark, root)).select(
        "id", "company_id", "amount_raised_usd", "confidence_score"
    )


@query(sql("""
    SELECT source_type, count(*) AS rounds FROM t_merged WHERE NOT is_duplicate GROUP BY source_type"""))
def rounds_by_source(spark, root):
    return reporting.rounds_by_source(_merged(spark, root))


@query(sql("""
    SELECT CAST(coalesce(sum(CAST(amount_raised_usd AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_amount_raised_usd
    FROM t_merged WHERE NOT is_duplicate"""))
def total_amount_raised(spark, root):
    exact = _merged(spark, root).withColumn("amount_raised_usd", F.col("amount_raised_usd").cast(EXACT))
    return reporting.total_amount_raised(exact).select(F.col("total_amount_raised_usd").cast("double"))


@query(sql("""
    SELECT (SELECT count(*) FROM t_companies) AS companies,
           (SELECT count(*) FROM t_merged WHERE NOT is_duplicate) AS funding_rounds,
           (SELECT count(*) FROM t_rounds) AS total_rounds_including_duplicates,
           (SELECT count(*) FROM t_investors) AS investors, (SELECT count(*) FROM lineitem) AS sources,
           (SELECT count(*) FROM t_losers) AS duplicates_found,
           (SELECT CAST(sum(CAST(amount_raised_usd AS DECIMAL(18,2))) AS DOUBLE) FROM t_merged
            WHERE NOT is_duplicate) AS total_amount_raised_usd"""))
def table_statistics(spark, root):
    exact = _merged(spark, root).withColumn("amount_raised_usd", F.col("amount_raised_usd").cast(EXACT))
    stats = reporting.statistics(
        shapes.companies(spark, root), exact, shapes.investors(spark, root), shapes.sources(spark, root)
    )
    return stats.withColumn("total_amount_raised_usd", F.col("total_amount_raised_usd").cast("double"))


@query(sql("SELECT company_id, source_type, count(*) AS rounds_found FROM t_rounds GROUP BY ALL"))
def rounds_found_per_company(spark, root):
    return records.rounds_found(shapes.rounds(spark, root))


@query(sql("""
    SELECT l.round_id, string_agg(i.name, ', ' ORDER BY i.id) AS investors
    FROM (SELECT DISTINCT * FROM t_links) l JOIN t_investors i ON l.investor_id = i.id GROUP BY l.round_id"""))
def investor_names_per_round(spark, root):
    return reporting.investor_names(shapes.links(spark, root), shapes.investors(spark, root))


EXPORT_SQL = """
    SELECT c.name AS "Company Name", coalesce(c.cik, '') AS "Company CIK",
           coalesce(r.round_name, '') AS "Round Name", coalesce(r.date, '') AS "Date",
           r.amount_raised_usd AS "Amount Raised (USD)",
           r.pre_money_valuation_usd AS "Pre-Money Valuation (USD)",
           r.post_money_valuation_usd AS "Post-Money Valuation (USD)",
           coalesce(r.lead_investor, '') AS "Lead Investor", coalesce(n.investors, '') AS "All Investors",
           r.source_type AS "Source Type", r.confidence_score AS "Confidence Score",
           r.source_urls AS "Source URLs", coalesce(r.notes, '') AS "Notes"
    FROM t_merged r JOIN t_companies c ON r.company_id = c.id
    LEFT JOIN (SELECT l.round_id, string_agg(i.name, ', ' ORDER BY i.id) AS investors
               FROM (SELECT DISTINCT * FROM t_links) l JOIN t_investors i ON l.investor_id = i.id
               GROUP BY l.round_id) n ON n.round_id = r.id
    WHERE NOT r.is_duplicate"""


def export_frame(spark, root) -> DataFrame:
    return reporting.export_rows(
        _merged(spark, root), shapes.companies(spark, root), shapes.links(spark, root),
        shapes.investors(spark, root),
    )


@query(sql(EXPORT_SQL))
def export_rows(spark, root):
    return export_frame(spark, root)


# ------------------------------------------------------------------ status


@query(sql("""
    SELECT id, name, cik, stage1_resolved, stage2_sec_collected, stage3_search_extracted, stage4_merged
    FROM t_companies JOIN t_status ON id = company_id"""))
def companies_with_status(spark, root):
    joined = stage_status.companies_with_status(shapes.companies(spark, root), shapes.status(spark, root))
    return joined.select(
        "id", "name", "cik", "stage1_resolved", "stage2_sec_collected", "stage3_search_extracted",
        "stage4_merged",
    )


@query(sql("""
    SELECT 1 AS stage, company_id AS id FROM t_status WHERE NOT stage1_resolved
    UNION ALL SELECT 2, company_id FROM t_status WHERE NOT stage2_sec_collected
    UNION ALL SELECT 3, company_id FROM t_status WHERE NOT stage3_search_extracted
    UNION ALL SELECT 4, company_id FROM t_status WHERE NOT stage4_merged
    UNION ALL SELECT 9, company_id FROM t_status"""))
def companies_needing_stage(spark, root):
    companies, status = shapes.companies(spark, root), shapes.status(spark, root)
    parts = [
        stage_status.companies_needing_stage(companies, status, n).select(F.lit(n).alias("stage"), "id")
        for n in (1, 2, 3, 4, 9)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(sql("SELECT id, name FROM t_companies WHERE id IN (SELECT company_id FROM t_status WHERE NOT stage2_sec_collected)"))
def pending_work(spark, root):
    return stage_status.pending_work(shapes.companies(spark, root), shapes.status(spark, root), 2)


@query(sql("SELECT company_id, stage3_rounds_found AS rounds_found FROM t_status WHERE stage3_search_extracted"))
def finished_counts(spark, root):
    return stage_status.finished_counts(shapes.status(spark, root), 3)


@query(sql("""
    SELECT company_id, stage1_resolved, stage2_sec_collected, stage2_rounds_found,
           false AS stage3_search_extracted, CAST(0 AS INT) AS stage3_rounds_found,
           false AS stage4_merged FROM t_status"""))
def reset_stages(spark, root):
    return stage_status.reset_status(shapes.status(spark, root), (3, 4)).select(
        "company_id", "stage1_resolved", "stage2_sec_collected", "stage2_rounds_found",
        "stage3_search_extracted", "stage3_rounds_found", "stage4_merged",
    )


@query(sql("""
    SELECT coalesce(s.company_id, e.company_id) AS company_id,
           coalesce(e.completed, s.stage2_sec_collected) AS stage2_sec_collected,
           CASE WHEN e.company_id IS NULL
                THEN strftime(TIMESTAMP '2024-01-01' + to_seconds(s.stage2_second), '%Y-%m-%d %H:%M:%S')
                WHEN e.completed THEN strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS stage2_at,
           coalesce(e.counted, s.stage2_rounds_found) AS stage2_rounds_found,
           coalesce(s.stage4_merged, false) AS stage4_merged
    FROM t_status s FULL JOIN (
      SELECT account AS company_id, arg_max(success, ts) AS completed, max(ts) AS ts,
             arg_max(input_tokens, ts) AS counted FROM t_calls GROUP BY account) e
    ON s.company_id = e.company_id"""))
def stage_completions(spark, root):
    log = shapes.calls(spark, root).select(
        F.col("account").alias("company_id"), F.col("ts").alias("at"), F.col("success").alias("completed"),
        F.col("input_tokens").alias("counted"),
    )
    return stage_status.apply_completions(shapes.status(spark, root), log, 2).select(
        "company_id", "stage2_sec_collected",
        F.date_format("stage2_completed_at", "yyyy-MM-dd HH:mm:ss").alias("stage2_at"),
        "stage2_rounds_found", "stage4_merged",
    )


@query(sql("""
    SELECT account, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(provider_name, (ts, event_id)) AS provider_name
    FROM t_calls GROUP BY account"""))
def latest_call_per_account(spark, root):
    calls = shapes.calls(spark, root).select("account", "ts", "event_id", "provider_name")
    return stage_status.latest_per_key(calls, ["account"], "ts").drop("ts")


@query(sql("""
    SELECT total AS total_companies, s1 AS stage1_completed, s2 AS stage2_completed, s3 AS stage3_completed,
           s4 AS stage4_completed, round(100.0 * s1 / total, 6) AS stage1_percent,
           round(100.0 * s2 / total, 6) AS stage2_percent, round(100.0 * s3 / total, 6) AS stage3_percent,
           round(100.0 * s4 / total, 6) AS stage4_percent
    FROM (SELECT (SELECT count(*) FROM t_companies) AS total, count(*) FILTER (stage1_resolved) AS s1,
                 count(*) FILTER (stage2_sec_collected) AS s2, count(*) FILTER (stage3_search_extracted) AS s3,
                 count(*) FILTER (stage4_merged) AS s4 FROM t_status)"""))
def processing_progress(spark, root):
    progress = stage_status.processing_progress(shapes.companies(spark, root), shapes.status(spark, root))
    return progress.select(*[
        F.round(c, 6).alias(c) if c.endswith("percent") else F.col(c) for c in progress.columns
    ])


@query(sql("""
    SELECT CAST(2 AS INT) AS stage, count(*) AS companies, CAST(coalesce(sum(stage2_rounds_found), 0) AS BIGINT) AS rounds
    FROM t_status WHERE stage2_sec_collected
    UNION ALL SELECT 3, count(*), CAST(coalesce(sum(stage3_rounds_found), 0) AS BIGINT) FROM t_status WHERE stage3_search_extracted
    UNION ALL SELECT 4, count(*), CAST(0 AS BIGINT) FROM t_status WHERE stage4_merged"""))
def stage_totals(spark, root):
    return stage_status.stage_totals(shapes.status(spark, root))


@query(sql("""
    SELECT coalesce(s.company_id, n.company_id) AS company_id,
           coalesce(s.stage4_merged, false) OR n.company_id IS NOT NULL AS stage4_merged,
           CAST(coalesce(n.unique_rounds, 0) AS INT) AS stage4_unique_rounds
    FROM t_status s FULL JOIN (
      SELECT company_id, count(*) FILTER (NOT is_duplicate) AS unique_rounds FROM t_merged
      WHERE company_id NOT IN (SELECT company_id FROM t_status WHERE stage4_merged) GROUP BY company_id) n
    ON s.company_id = n.company_id"""))
def status_after_merge(spark, root):
    _, status = stages.merge_rounds(shapes.rounds(spark, root), shapes.status(spark, root), _now())
    return status.select("company_id", "stage4_merged", "stage4_unique_rounds")


@query(sql("""
    SELECT name, bool_or(known) AS is_known, CAST(count(*) AS INT) > 0 AS has_status FROM (
      SELECT name, id IN (SELECT company_id FROM t_status) AS known FROM t_companies
      WHERE id IN (SELECT company_id FROM t_status) UNION ALL SELECT s_name, false FROM supplier) GROUP BY name"""))
def registered_companies(spark, root):
    status = shapes.status(spark, root)
    held = shapes.companies(spark, root).join(status.select(F.col("company_id").alias("id")), "id", "left_semi")
    listed = table(spark, root, "supplier").select(F.col("s_name").alias("name"))
    companies, new_status = stages.register_companies(
        listed.unionByName(listed), held.select(shapes.companies(spark, root).columns), status, _now()
    )
    known = status.select(F.col("company_id").alias("id"), F.lit(True).alias("known"))
    rows = new_status.groupBy(F.col("company_id").alias("id")).agg(F.count("*").alias("n"))
    return companies.join(known, "id", "left").join(rows, "id", "left").select(
        "name", F.coalesce("known", F.lit(False)).alias("is_known"), (F.col("n") == 1).alias("has_status")
    )


@query("""
    SELECT p_partkey, CAST(0 AS BIGINT) AS ordinal, p_name AS title, p_partkey + 320000 AS cik FROM part
    UNION ALL SELECT p_partkey, 1, p_brand || ' "Ltd"', p_size FROM part""")
def ticker_directory(spark, root):
    payload = F.expr("""concat('{"9": {"cik_str": ', p_partkey + 320000, ', "ticker": "T", "title": "', p_name,
        '"}, "10": {"cik_str": ', p_size, ', "title": "', p_brand, ' \\\\"Ltd\\\\""}}')""")
    payloads = table(spark, root, "part").select("p_partkey", payload.alias("payload"))
    return filing_source.directory_entries(payloads, keep=("p_partkey",))


@query(sql("""
    SELECT completed, total, round(100.0 * completed / total, 6) AS percent FROM (
      SELECT row_number() OVER (ORDER BY stage2_second, company_id) AS completed,
             (SELECT count(*) FROM t_status) AS total FROM t_status WHERE stage2_sec_collected)
    WHERE completed % 10 = 0"""))
def running_progress(spark, root):
    progress = stage_status.running_progress(shapes.status(spark, root), 2, 10)
    return progress.withColumn("percent", F.round("percent", 6))


# ------------------------------------------------------------------ entities


@query(sql("""
    SELECT coalesce(c.name, i.name) AS name, c.id, coalesce(c.cik, i.cik) AS cik, i.official_name
    FROM t_companies c FULL JOIN (
      SELECT name, min(cik) AS cik, min(official_name) AS official_name FROM (
        SELECT CASE WHEN s_acctbal > 0 THEN 'Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') ELSE s_name END AS name,
               'S' || s_nationkey AS cik, nullif('Official ' || s_nationkey, 'Official 3') AS official_name
        FROM supplier) GROUP BY name) i ON c.name = i.name"""))
def upsert_companies(spark, root):
    incoming = table(spark, root, "supplier").selectExpr(
        "CASE WHEN s_acctbal > 0 THEN concat('Customer#', lpad(CAST(s_suppkey AS STRING), 9, '0')) ELSE s_name END AS name",
        "concat('S', s_nationkey) AS cik",
        "nullif(concat('Official ', s_nationkey), 'Official 3') AS official_name",
    )
    existing = shapes.companies(spark, root)
    known = existing.select("name", F.col("id").alias("known_id"))
    return entities.upsert_companies(existing, incoming, _now()).join(known, "name", "left").select(
        "name", F.col("known_id").alias("id"), "cik", "official_name"
    )


_NAMED = """(SELECT o_orderkey AS round_id, trim(name) AS name
    FROM (SELECT o_orderkey, unnest(all_investors) AS name FROM t_records) WHERE trim(name) <> '')"""


def _named(spark, root) -> DataFrame:
    answers = shapes.responses(spark, root).withColumn("company_id", F.col("o_orderkey"))
    return entities.exploded_investors(
        records.response_records(answers).withColumnRenamed("company_id", "id")
    )


@query(sql(f"SELECT name FROM t_investors UNION SELECT name FROM {_NAMED}"))
def upsert_investors(spark, root):
    return entities.upsert_investors(shapes.investors(spark, root), _named(spark, root), _now()).select("name")


@query(sql(f"SELECT DISTINCT round_id, name FROM {_NAMED}"))
def investor_links(spark, root):
    named = _named(spark, root)
    known = entities.upsert_investors(shapes.investors(spark, root), named, _now())
    links = entities.investor_links(named, known)
    names = known.select(F.col("id").alias("investor_id"), "name")
    return links.join(names, "investor_id").select("round_id", "name")


@query("SELECT DISTINCT l_orderkey AS round_id, l_suppkey AS investor_id FROM lineitem")
def distinct_links(spark, root):
    return shapes.links(spark, root).dropDuplicates(["round_id", "investor_id"])


_RESOLVE_NAMES = """CASE WHEN c_nationkey < 8 THEN upper(split_part({part}, ' ', 1))
    WHEN c_nationkey < 12 THEN split_part({part}, ' ', 2)
    WHEN c_nationkey < 16 THEN concat('The ', {part}, ' Group')
    WHEN c_nationkey < 18 THEN substring({part}, 1, 2) WHEN c_nationkey = 18 THEN ''
    ELSE c_name END"""


@query(f"""
    WITH names AS (SELECT c_custkey AS id, {_RESOLVE_NAMES.format(part='p_name')} AS name
                   FROM customer JOIN part ON c_custkey = p_partkey),
    entries AS (SELECT min(p_partkey) AS ordinal, lower(p_name) AS title FROM part GROUP BY lower(p_name)),
    found AS (SELECT id, min(ordinal) AS ordinal FROM (SELECT DISTINCT id, lower(name) AS name FROM names) n
              JOIN entries ON contains(title, n.name) OR contains(n.name, title) GROUP BY id)
    SELECT n.id, n.name, lpad(CAST(p_partkey + 320000 AS VARCHAR), 10, '0') AS cik, p_name AS official_name
    FROM names n LEFT JOIN found f ON n.id = f.id LEFT JOIN part ON f.ordinal = p_partkey""")
def resolved_companies(spark, root):
    part = table(spark, root, "part")
    companies = table(spark, root, "customer").join(
        part.select(F.col("p_partkey").alias("c_custkey"), "p_name"), "c_custkey"
    ).selectExpr("c_custkey AS id", f"{_RESOLVE_NAMES.format(part='p_name')} AS name")
    directory = part.selectExpr("p_partkey AS ordinal", "p_partkey + 320000 AS cik", "p_name AS title")
    return resolve.resolve_companies(companies, directory)


@query("""
    SELECT o_custkey AS company_id, o_orderkey AS id,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position FROM orders""")
def round_positions(spark, root):
    rounds = shapes.rounds(spark, root).select("company_id", "id")
    return ranking.rank_within(rounds, "company_id", ["id"])


# ------------------------------------------------------------------ collected rounds and sources


def _form_d(spark, root) -> DataFrame:
    return records.form_d_records(shapes.filing_documents(spark, root))


@query(sql("""
    SELECT company_id, company_name, 'Form D Filing' AS round_name, filing_date AS date,
           read_amount AS amount_raised_usd, 'SEC_FORM_D' AS source_type, 'HIGH' AS confidence_score,
           'https://www.sec.gov/Archives/edgar/data/' || company_id || '/' || replace(accession_number, '-', '')
             || '/primary_doc.xml' AS source_url,
           'SEC Form D filing (Accession: ' || accession_number || ')' AS notes
    FROM t_offerings WHERE is_offering"""))
def form_d_rounds(spark, root):
    rows = records.round_rows(_form_d(spark, root), records.SEC, records.HIGH, _now())
    return rows.select(
        "company_id", F.get_json_object("raw_data", "$.company_name").alias("company_name"), "round_name",
        "date", "amount_raised_usd", "source_type", "confidence_score",
        F.get("source_urls", F.lit(0)).alias("source_url"), "notes",
    )


@query(sql("""
    SELECT f.o_orderkey, f.filing_date, d.is_offering, CASE WHEN d.is_offering THEN d.read_amount END AS amount
    FROM t_filings f JOIN t_offerings d ON f.accession_number = d.accession_number
    WHERE f.form = 'D' AND f.accession_number <> ''"""))
def collected_offerings(spark, root):
    from capledger.functions.filings import offering

    filed = filing_source.offering_filings(filing_source.filings(shapes.filing_indexes(spark, root)))
    documents = shapes.filing_documents(spark, root).select("accession_number", "document")
    return filed.join(documents, "accession_number").select(
        "o_orderkey", "filing_date", F.inline(F.array(offering(F.col("document"))))
    )


def _web(spark, root) -> DataFrame:
    return records.round_rows(
        records.response_records(shapes.responses(spark, root)), records.WEB, records.MEDIUM, _now()
    )


@query(sql("""
    SELECT company_id, round_name, date, TRY_CAST(amount_raised_usd AS DOUBLE) AS amount_raised_usd,
           'WEB_SEARCH' AS source_type, 'MEDIUM' AS confidence_score, nullif(source_url, '') AS source_urls,
           false AS is_duplicate
    FROM t_records"""))
def web_round_rows(spark, root):
    return _web(spark, root).select(
        "company_id", "round_name", "date", "amount_raised_usd", "source_type", "confidence_score",
        F.array_join("source_urls", ", ").alias("source_urls"), "is_duplicate",
    )


@query(sql("""
    SELECT company_id, 'SEC_FORM_D' AS source_type, filing_date AS date FROM t_offerings WHERE is_offering
    UNION ALL SELECT company_id, 'WEB_SEARCH', date FROM t_records"""))
def all_collected_rounds(spark, root):
    sec = records.round_rows(_form_d(spark, root), records.SEC, records.HIGH, _now())
    return records.all_rounds(sec, _web(spark, root)).select("company_id", "source_type", "date")


@query(sql("""
    SELECT 'SEC_FORM_D' AS source_type, count(*) AS n_rows, count(*) AS n_ids FROM t_offerings WHERE is_offering
    UNION ALL SELECT 'WEB_SEARCH', count(*), count(*) FROM t_records"""))
def round_identity(spark, root):
    """Every collected round has an id of its own, equal ones too."""
    sec = records.round_rows(_form_d(spark, root), records.SEC, records.HIGH, _now())
    counts = (F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids"))
    return records.all_rounds(sec, _web(spark, root)).groupBy("source_type").agg(*counts)


@query(sql("""
    SELECT company_id, round_name, source_url FROM t_records"""))
def raw_objects(spark, root):
    """The stored objects of answers are whole: read again, they give the same rounds."""
    raw = F.col("raw_data")
    return _web(spark, root).select(
        "company_id", F.get_json_object(raw, "$.round_name").alias("round_name"),
        F.get_json_object(raw, "$.source_url").alias("source_url"),
    )


@query(sql("""
    SELECT 'SEC_FORM_D' AS source_type,
           'https://www.sec.gov/Archives/edgar/data/' || company_id || '/' || replace(accession_number, '-', '')
             || '/primary_doc.xml' AS url,
           'SEC Form D - ' || coalesce(filing_date, 'None') AS title,
           'SEC Form D filing (Accession: ' || accession_number || ')' AS snippet
    FROM t_offerings WHERE is_offering"""))
def filing_sources(spark, root):
    rows = records.round_rows(_form_d(spark, root), records.SEC, records.HIGH, _now())
    return records.filing_sources(rows, _now()).select("source_type", "url", "title", "snippet")


@query(sql("""
    SELECT company_id, url, arg_min(title, (query_no, rank)) AS title FROM t_hits GROUP BY company_id, url"""))
def first_hits(spark, root):
    hits = search_source.search_hits(shapes.landed_hits(spark, root))
    return records.first_hits(hits).select("company_id", "url", "title")


@query(sql("""
    SELECT r.source_url AS url, CASE WHEN length(h.title) > 490 THEN substring(h.title, 1, 490) || '...'
             ELSE h.title END AS title, h.snippet, 'round_robin' AS llm_provider, 'MEDIUM' AS extraction_confidence
    FROM (SELECT company_id, CASE WHEN source_url <> '' AND date <> '1997-05'
                 THEN 'https://deals.example/shared' ELSE source_url END AS source_url FROM t_records) r
    LEFT JOIN (SELECT company_id, url, arg_min(title, (query_no, rank)) AS title,
                      arg_min(snippet, (query_no, rank)) AS snippet FROM t_hits GROUP BY company_id, url) h
      ON r.company_id = h.company_id AND r.source_url = h.url WHERE r.source_url <> ''"""))
def web_sources(spark, root):
    url = F.when(
        (F.col("source_url") != "") & (F.col("date") != "1997-05"), F.lit("https://deals.example/shared")
    ).otherwise(F.col("source_url"))
    hits = search_source.search_hits(shapes.landed_hits(spark, root))
    web = _web(spark, root).withColumn("source_url", url)
    return records.web_sources(web, hits, "round_robin", _now()).select(
        "url", "title", "snippet", "llm_provider", "extraction_confidence"
    )


# ------------------------------------------------------------------ constraints


def _tables(spark, root) -> dict[str, DataFrame]:
    """The stored tables, with companies and investors in debt missing."""
    return {
        "companies": shapes.companies(spark, root).join(
            table(spark, root, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("id")), "id", "left_semi"
        ),
        "funding_rounds": shapes.rounds(spark, root),
        "investors": shapes.investors(spark, root).join(
            table(spark, root, "supplier").where("s_acctbal >= 0").select(F.col("s_suppkey").alias("id")), "id", "left_semi"
        ),
        "round_investors": shapes.links(spark, root),
        "sources": shapes.sources(spark, root),
        "processing_status": shapes.status(spark, root),
    }


@query(sql("""
    SELECT 'funding_rounds' AS child, 'company_id' AS column_name, 'companies' AS parent,
           count(DISTINCT company_id) AS orphan_keys, count(*) AS orphan_rows
    FROM t_rounds WHERE company_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    UNION ALL SELECT 'funding_rounds', 'duplicate_of_id', 'funding_rounds', 0, 0
    UNION ALL SELECT 'round_investors', 'round_id', 'funding_rounds', count(DISTINCT round_id), count(*)
    FROM t_links WHERE round_id NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'round_investors', 'investor_id', 'investors', count(DISTINCT investor_id), count(*)
    FROM t_links WHERE investor_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
    UNION ALL SELECT 'sources', 'round_id', 'funding_rounds', count(DISTINCT round_id), count(*)
    FROM t_links WHERE round_id NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'processing_status', 'company_id', 'companies', count(DISTINCT company_id), count(*)
    FROM t_status WHERE company_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""))
def orphan_report(spark, root):
    return quality.orphan_report(_tables(spark, root))


@query(sql("""
    SELECT 'companies' AS table_name, 'name' AS key_columns, count(*) AS repeated_keys,
           CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved
    FROM (SELECT c_name, count(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'investors', 'name', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
    FROM (SELECT s_name, count(*) AS n FROM supplier WHERE s_acctbal >= 0 GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'processing_status', 'company_id', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
    FROM (SELECT company_id, count(*) AS n FROM t_status GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'round_investors', 'round_id,investor_id', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
    FROM (SELECT round_id, investor_id, count(*) AS n FROM t_links GROUP BY 1, 2 HAVING count(*) > 1)"""))
def uniqueness_report(spark, root):
    return quality.uniqueness_report(_tables(spark, root))


@query("""
    SELECT 'sources' AS table_name, * FROM (
      SELECT 'title' AS column_name, 'max_length_500' AS rule, count(*) FILTER (length(text) > 500) AS violations FROM documents
      UNION ALL SELECT 'url', 'max_length_2000', count(*) FILTER (length(text) > 2000) FROM documents
      UNION ALL SELECT 'source_type', 'max_length_50', count(*) FILTER (length(source) > 50) FROM documents
      UNION ALL SELECT 'llm_provider', 'max_length_50', count(*) FILTER (length(lang) > 50) FROM documents
      UNION ALL SELECT 'round_id', 'not_null', count(*) FILTER (n_chars <= 500) FROM documents
      UNION ALL SELECT 'source_type', 'not_null', 0)""")
def constraint_report(spark, root):
    landed = table(spark, root, "documents").selectExpr(
        "CASE WHEN n_chars > 500 THEN doc_id END AS round_id", "source AS source_type", "text AS url",
        "text AS title", "lang AS llm_provider",
    )
    return quality.constraint_report({"sources": landed})


#: For each table the benchmark table and key its rows come from, and its rules as declared: "!" must not be
#: null, ":n" is at most n characters long.
_RULES = {
    "companies": ("customer", "c_custkey", "id! name!:500 cik:20 official_name:500 created_at! updated_at!"),
    "funding_rounds": (
        "orders", "o_orderkey",
        "id! company_id! round_name:100 date:50 lead_investor:500 source_type!:50 confidence_score!:20 is_duplicate! "
        "created_at! updated_at!",
    ),
    "investors": ("supplier", "s_suppkey", "id! name!:500 investor_type:50 created_at! updated_at!"),
    "round_investors": ("lineitem", "l_orderkey", "round_id! investor_id!"),
    "sources": (
        "lineitem", "l_partkey",
        "id! round_id! source_type!:50 url:2000 title:500 llm_provider:50 llm_model:100 extraction_confidence:20 created_at!",
    ),
    "processing_status": (
        "customer", "c_custkey",
        "id! company_id! stage1_resolved! stage2_sec_collected! stage2_rounds_found! stage3_search_extracted! "
        "stage3_rounds_found! stage4_merged! stage4_unique_rounds! has_errors! retry_count! created_at! updated_at!",
    ),
    "llm_usage": (
        "events", "event_id",
        "id! provider_name!:50 model_name!:100 total_calls! successful_calls! failed_calls! rate_limited_calls! "
        "total_input_tokens! total_output_tokens! date!:10 created_at! updated_at!",
    ),
}


def _rules():
    """(table, source, key, column, must not be null, length or "", every so-many-th key breaks the rule)."""
    for name, (source, key, columns) in _RULES.items():
        for place, rule in enumerate(columns.split(), 2):
            column, _, length = rule.partition(":")
            yield name, source, key, column.rstrip("!"), column.endswith("!"), length, place


def _constraints_sql() -> str:
    parts = []
    for name, source, key, column, required, length, every in _rules():
        start = f"SELECT '{name}' AS table_name, '{column}' AS column_name"
        if required:
            parts.append(f"{start}, 'not_null' AS rule, count(*) FILTER ({key} % {every} = 0) AS violations FROM {source}")
        if length:
            there = f" AND {key} % {every} <> 0" if required else ""
            parts.append(f"{start}, 'max_length_{length}' AS rule, count(*) FILTER ({key} % 2 = 1{there}) AS violations FROM {source}")
    return " UNION ALL ".join(parts)


@query(_constraints_sql())
def table_constraints(spark, root):
    """All rules of all seven tables; the rows break each of them for other keys."""
    columns: dict[str, list[str]] = {}
    for name, _, key, column, required, length, every in _rules():
        value = f"repeat('x', CAST({length} + {key} % 2 AS INT))" if length else key
        columns.setdefault(name, []).append(
            f"CASE WHEN {key} % {every} <> 0 THEN {value} END AS {column}" if required else f"{value} AS {column}"
        )
    return quality.constraint_report({
        name: table(spark, root, source).selectExpr(*columns[name]) for name, (source, _, _) in _RULES.items()
    })


@query(sql("""
    SELECT 'companies' AS table_name, count(*) AS kept FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0
    UNION ALL SELECT 'funding_rounds', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
    UNION ALL SELECT 'processing_status', count(*) FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0
    UNION ALL SELECT t.name, count(*) FROM lineitem, (VALUES ('round_investors'), ('sources')) t(name)
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')) GROUP BY t.name"""))
def cascading_delete(spark, root):
    gone = table(spark, root, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("id"))
    kept = quality.delete_companies(_tables(spark, root), gone)
    result = None
    for name, df in kept.items():
        part = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("kept"))
        result = part if result is None else result.unionByName(part)
    return result


@query(sql("""
    WITH gone AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'MACHINERY'),
    gone_rounds AS (SELECT o_orderkey AS id FROM orders WHERE o_custkey IN (SELECT id FROM gone))
    SELECT 'companies' AS table_name, CAST(c_custkey AS VARCHAR) AS key, 1 AS n FROM customer
    WHERE c_custkey NOT IN (SELECT id FROM gone) AND c_acctbal >= 0
    UNION ALL SELECT 'processing_status', CAST(c_custkey AS VARCHAR), 1 FROM customer WHERE c_custkey NOT IN (SELECT id FROM gone) AND c_acctbal >= 0
    UNION ALL SELECT 'funding_rounds', CAST(o_orderkey AS VARCHAR), 1 FROM orders WHERE o_custkey NOT IN (SELECT id FROM gone)
    UNION ALL SELECT 'round_investors', l_orderkey || '-' || l_suppkey, count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT id FROM gone_rounds) GROUP BY 2
    UNION ALL SELECT 'sources', 'https://deals.example/' || l_orderkey || '/' || l_linenumber, count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT id FROM gone_rounds) GROUP BY 2"""))
def rows_after_cascading_delete(spark, root):
    """What is left of five tables, row by row."""
    gone = table(spark, root, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("id"))
    keys = {
        "companies": F.col("id").cast("string"), "processing_status": F.col("company_id").cast("string"),
        "funding_rounds": F.col("id").cast("string"), "round_investors": F.concat_ws("-", "round_id", "investor_id"), "sources": F.col("url"),
    }
    tables = _tables(spark, root)
    kept = quality.delete_companies(tables, gone)
    parts = [spread(kept[n].select(k.alias("key")), "key", like=tables[n]).groupBy("key").agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "key", "n") for n, k in keys.items()]
    return reduce(DataFrame.unionByName, parts)
