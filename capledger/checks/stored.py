"""Queries over the versioned store: the stages as commits, changes beside rows, repeated collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from capledger.checks import shapes
from capledger.checks.movement import workspace
from capledger.checks.registry import query
from capledger.checks.shapes import sql, table
from capledger.plans import stored
from capledger.session import sized
from capledger.sources.search import search_hits
from capledger.sources.store import Store


def now(day: int):
    return F.lit(f"2024-02-{day:02d} 00:00:00").cast("timestamp")


def store_of(spark, root, **tables: DataFrame) -> Store:
    """A new store that holds the given tables as its first version."""
    store = Store(spark, workspace(spark))
    with store.transaction() as tx:
        for name, rows in tables.items():
            tx.append(name, rows)
    return store


@query(sql("""
    SELECT coalesce(s.company_id, e.company_id) AS company_id,
           coalesce(e.completed, s.stage2_sec_collected) AS stage2_sec_collected,
           CASE WHEN e.company_id IS NULL
                THEN strftime(TIMESTAMP '2024-01-01' + to_seconds(s.stage2_second), '%Y-%m-%d %H:%M:%S')
                WHEN e.completed THEN strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS stage2_at,
           coalesce(e.counted, s.stage2_rounds_found) AS stage2_rounds_found
    FROM t_status s FULL JOIN (
      SELECT account AS company_id, arg_max(success, ts) AS completed, max(ts) AS ts,
             arg_max(input_tokens, ts) AS counted FROM t_calls GROUP BY account) e
    ON s.company_id = e.company_id"""))
def stored_completions(spark, root):
    """Completions in three commits, the last of them of rows that the first two touched or not; read over the changes."""
    store = store_of(spark, root, processing_status=shapes.status(spark, root))
    log = shapes.calls(spark, root).select(
        F.col("account").alias("company_id"), F.col("ts").alias("at"), F.col("success").alias("completed"),
        F.col("input_tokens").alias("counted"),
    )
    day = F.dayofmonth("at")
    for part in (day < 10, (day >= 10) & (day < 20), day >= 20):
        stored.complete_stage(store, log.where(part), 2)
    return store.read("processing_status").select(
        "company_id", "stage2_sec_collected", F.date_format("stage2_completed_at", "yyyy-MM-dd HH:mm:ss").alias("stage2_at"),
        "stage2_rounds_found",
    )


_OPEN = "company_id NOT IN (SELECT company_id FROM t_status WHERE stage4_merged)"


@query(sql(f"""
    SELECT id, company_id, round_name, is_duplicate AND {_OPEN} AS is_duplicate,
           CASE WHEN {_OPEN} THEN duplicate_of_id END AS duplicate_of_id FROM t_merged"""))
def stored_marks(spark, root):
    """Duplicates marked by a commit that writes the losing rounds only."""
    store = store_of(spark, root, funding_rounds=shapes.rounds(spark, root), processing_status=shapes.status(spark, root))
    stored.merge_rounds(store, now(1))
    return store.read("funding_rounds").select("id", "company_id", "round_name", "is_duplicate", "duplicate_of_id")


@query(sql("""
    SELECT company_id, CASE WHEN company_id % 5 <> 0 OR NOT stage4_merged THEN stage2_sec_collected ELSE false END AS stage2,
           stage3_search_extracted AS stage3 FROM t_status WHERE company_id % 7 <> 0"""))
def stored_changes(spark, root):
    """Rows changed, taken away, added again and folded in; an earlier version is still there to read."""
    store = store_of(spark, root, processing_status=shapes.status(spark, root))
    rows = store.read("processing_status")
    with store.transaction() as tx:
        tx.change("processing_status", rows.where("company_id % 5 = 0 AND stage4_merged").withColumn("stage2_sec_collected", F.lit(False)))
        tx.remove("processing_status", rows.where("company_id % 7 = 0 OR company_id % 11 = 0").select("company_id"))
    store.compact("processing_status")
    with store.transaction() as tx:
        again = store.read("processing_status", version=1).where("company_id % 11 = 0 AND company_id % 7 <> 0")
        turned = F.when((F.col("company_id") % 5 == 0) & F.col("stage4_merged"), False).otherwise(F.col("stage2_sec_collected"))
        tx.append("processing_status", again.withColumn("stage2_sec_collected", turned))
    return store.read("processing_status").select(
        "company_id", F.col("stage2_sec_collected").alias("stage2"), F.col("stage3_search_extracted").alias("stage3")
    )


def _directory(spark, root) -> DataFrame:
    """Entries for every ninth company, under its own name in capitals."""
    return table(spark, root, "customer").where("c_custkey % 9 = 0").selectExpr(
        "c_custkey AS ordinal", "c_custkey AS cik", "upper(c_name) AS title"
    )


def _filed(spark, root) -> tuple[DataFrame, DataFrame]:
    """Filings indexes and documents by id."""
    indexes = shapes.filing_indexes(spark, root).selectExpr("lpad(CAST(company_id AS STRING), 10, '0') AS cik", "payload")
    return indexes, shapes.filing_documents(spark, root).select("cik", "accession_number", "document")


@query(sql("""
    SELECT s.company_id, c.cik IS NOT NULL OR (c.id % 9 = 0 AND NOT s.stage2_sec_collected) AS has_cik,
           stage2_sec_collected OR true AS stage2_done,
           CASE WHEN stage2_sec_collected THEN stage2_rounds_found ELSE CAST(coalesce(n, 0) AS INT) END AS found,
           CASE WHEN stage2_sec_collected THEN 0 ELSE coalesce(n, 0) END AS n_rounds,
           CASE WHEN NOT stage2_sec_collected THEN amount END AS amount, CASE WHEN NOT stage2_sec_collected THEN first_title END AS first_title
    FROM t_status s JOIN t_companies c ON c.id = s.company_id LEFT JOIN (
      SELECT company_id, count(*) AS n, CAST(sum(CAST(read_amount AS DECIMAL(18, 2))) AS DOUBLE) AS amount,
             min('SEC Form D - ' || filing_date) AS first_title
      FROM t_offerings WHERE is_offering AND filing_date IS NOT NULL AND (company_id % 3 <> 0 OR company_id % 9 = 0) GROUP BY company_id) o
    ON o.company_id = s.company_id"""))
def collected_filings_stage(spark, root):
    """Stage 2 as one commit: ids resolved, filings read, status written."""
    status = shapes.status(spark, root)
    companies = shapes.companies(spark, root).join(status.select(F.col("company_id").alias("id")), "id", "left_semi")
    store = store_of(spark, root, companies=companies, processing_status=status)
    stored.collect_filings(store, _directory(spark, root), *_filed(spark, root), now(1))
    titles = store.read("sources").select(F.col("round_id").alias("id"), "title")
    rounds = store.read("funding_rounds").join(titles, "id").groupBy("company_id").agg(
        F.count("*").alias("n"), F.sum(F.col("amount_raised_usd").cast("decimal(18,2)")).cast("double").alias("amount"),
        F.min("title").alias("first_title"),
    )
    ids = store.read("companies").select(F.col("id").alias("company_id"), F.col("cik").isNotNull().alias("has_cik"))
    return store.read("processing_status").join(ids, "company_id").join(rounds, "company_id", "left").select(
        "company_id", "has_cik", F.col("stage2_sec_collected").alias("stage2_done"), F.col("stage2_rounds_found").alias("found"),
        F.coalesce("n", F.lit(0)).alias("n_rounds"), "amount", "first_title",
    )


def _searched(spark, root) -> tuple[DataFrame, DataFrame]:
    hits = search_hits(shapes.landed_hits(spark, root))
    return hits, shapes.responses(spark, root).select("company_id", "response")


_EXTRACTED = """
    SELECT company_id, count(*) AS n, CAST(sum(TRY_CAST(amount_raised_usd AS DECIMAL(18, 2))) AS DOUBLE) AS amount,
           count(*) FILTER (source_url <> '') AS n_sources,
           CAST(sum(len(list_distinct(list_filter(list_transform(coalesce(all_investors, []), lambda x: trim(x)),
             lambda x: x <> '')))) AS BIGINT) AS n_links
    FROM t_records GROUP BY company_id"""


def _collected_per_company(store: Store) -> DataFrame:
    rounds = store.read("funding_rounds").select("id", "company_id", F.col("amount_raised_usd").cast("decimal(18,2)").alias("amount"))
    sources = sized(store.read("sources"), store.count_at_most("sources")).groupBy(F.col("round_id").alias("id")).agg(F.count("*").alias("n_sources"))
    links = sized(store.read("round_investors"), store.count_at_most("round_investors")).groupBy(F.col("round_id").alias("id")).agg(F.count("*").alias("n_links"))
    return rounds.join(sources, "id", "left").join(links, "id", "left").groupBy("company_id").agg(
        F.count("*").alias("n"), F.sum("amount").cast("double").alias("amount"), F.coalesce(F.sum("n_sources"), F.lit(0)).alias("n_sources"),
        F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links"),
    )


@query(sql(f"""
    SELECT s.company_id, true AS stage3_done,
           CASE WHEN stage3_search_extracted THEN stage3_rounds_found ELSE CAST(coalesce(n, 0) AS INT) END AS found,
           CASE WHEN stage3_search_extracted THEN 0 ELSE coalesce(n, 0) END AS n_rounds,
           CASE WHEN NOT stage3_search_extracted THEN amount END AS amount,
           CASE WHEN stage3_search_extracted THEN 0 ELSE coalesce(n_sources, 0) END AS n_sources,
           CASE WHEN stage3_search_extracted THEN 0 ELSE coalesce(n_links, 0) END AS n_links
    FROM t_status s LEFT JOIN ({_EXTRACTED}) e ON e.company_id = s.company_id"""))
def collected_search_stage(spark, root):
    """Stage 3 as one commit: rounds, sources, investors and links from model answers."""
    store = store_of(
        spark, root, companies=shapes.companies(spark, root), processing_status=shapes.status(spark, root),
        investors=shapes.investors(spark, root),
    )
    stored.collect_search(store, *_searched(spark, root), "round_robin", now(1))
    return store.read("processing_status").join(_collected_per_company(store), "company_id", "left").select(
        "company_id", F.col("stage3_search_extracted").alias("stage3_done"), F.col("stage3_rounds_found").alias("found"),
        F.coalesce("n", F.lit(0)).alias("n_rounds"), "amount", F.coalesce("n_sources", F.lit(0)).alias("n_sources"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


@query(sql(f"""
    SELECT e.company_id, 2 * n AS n_rounds, 2 * n_sources AS n_sources, 2 * n_links AS n_links, n AS contents, true AS all_dated_marked,
           false AS undated_marked, true AS kept_one
    FROM t_status s JOIN ({_EXTRACTED}) e ON e.company_id = s.company_id"""))
def repeated_collection(spark, root):
    """Collect, reset, collect again and merge: all rounds are there twice, and the merge marks one of each dated pair at least."""
    store = store_of(
        spark, root, companies=shapes.companies(spark, root), processing_status=shapes.status(spark, root),
        investors=shapes.investors(spark, root),
    )
    stored.reset_stages(store)
    for day in (1, 2):
        stored.collect_search(store, *_searched(spark, root), "round_robin", now(day))
        stored.reset_stages(store, (3,))
    stored.merge_rounds(store, now(3))
    rounds = store.read("funding_rounds")
    content = rounds.groupBy("company_id", F.xxhash64("raw_data").alias("content")).agg(
        F.count_if("is_duplicate").alias("marked"), (F.count("*") / 2).cast("long").alias("pairs"), F.max("date").alias("date"),
    )
    checked = content.groupBy("company_id").agg(
        F.sum("pairs").alias("contents"), F.bool_and(F.col("date").isNull() | (F.col("marked") >= F.col("pairs"))).alias("all_dated_marked"),
        F.bool_or(F.col("date").isNull() & (F.col("marked") > 0)).alias("undated_marked"),
    )
    kept = rounds.where("NOT is_duplicate").select("company_id").distinct().withColumn("kept_one", F.lit(True))
    checked, kept = (sized(df, store.count_at_most("companies")) for df in (checked, kept))
    return _collected_per_company(store).join(checked, "company_id").join(kept, "company_id", "left").select(
        "company_id", F.col("n").alias("n_rounds"), "n_sources", "n_links", "contents", "all_dated_marked", "undated_marked", "kept_one",
    )


@query(sql(f"""
    SELECT 'Company ' || c_custkey AS name, CAST(coalesce(n, 0) AS INT) AS found, coalesce(n, 0) > 0 AS merged,
           coalesce(n, 0) AS n_rounds, coalesce(dated, 0) > 0 AS dated
    FROM customer LEFT JOIN ({_EXTRACTED}) ON c_custkey = company_id LEFT JOIN (
      SELECT company_id, count(*) FILTER (date IS NOT NULL) AS dated FROM t_records GROUP BY company_id) d ON d.company_id = c_custkey"""))
def stored_pipeline(spark, root):
    """Register, collect and merge through stored tables, from nothing; each stage reads what the one before has committed."""
    store = Store(spark, workspace(spark))
    names = table(spark, root, "customer").selectExpr("concat('Company ', c_custkey) AS name")
    stored.register_companies(store, names, now(1))
    stored.register_companies(store, names, now(2))
    hits, responses = _searched(spark, root)
    known = store.read("companies").select(F.col("id").alias("company_id"), "name")
    answers = responses.withColumn("name", F.concat(F.lit("Company "), "company_id")).drop("company_id").join(known, "name")
    stored.collect_search(store, hits, answers.select("company_id", "response"), "round_robin", now(3))
    stored.merge_rounds(store, now(4))
    rounds = store.read("funding_rounds").groupBy("company_id").agg(
        F.count("*").alias("n"), F.max(F.col("date").isNotNull()).alias("dated"),
    )
    return known.join(store.read("processing_status"), "company_id").join(rounds, "company_id", "left").select(
        "name", F.col("stage3_rounds_found").alias("found"), F.col("stage4_merged").alias("merged"),
        F.coalesce("n", F.lit(0)).alias("n_rounds"), F.coalesce("dated", F.lit(False)).alias("dated"),
    )
