"""Operators on small frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from capledger.operators import dedup, entities, quality, ranking, resolve, rounds, status, usage
from capledger.schema import COMPANIES, FUNDING_ROUNDS, PROCESSING_STATUS
from capledger.sources import filings as filing_source, search as search_source
from capledger.options import DedupOptions, SearchOptions

T0 = dt.datetime(2024, 1, 1)


def now():
    return F.lit(T0)


def test_resolution_takes_the_first_containing_entry(spark):
    rng = random.Random(5)
    words = ["alpha", "al", "beta corp", "gamma", "Inc", "the", "x"]
    titles = [" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(40)] + [None]
    names = [" ".join(rng.choices(words, k=rng.randint(1, 4))).upper() for _ in range(60)]
    names += ["", "a", "zz", "beta corp gamma the longest of them all", None, "é"]
    directory = spark.createDataFrame([(i, t, 100 + i) for i, t in enumerate(titles)], "ordinal BIGINT, title STRING, cik BIGINT")
    companies = spark.createDataFrame(list(enumerate(names)), "id BIGINT, name STRING")
    want = {}
    for i, name in enumerate(names):
        hit = next((j for j, t in enumerate(titles) if name is not None and t is not None
                    and (name.lower() in t.lower() or t.lower() in name.lower())), None)
        want[i] = None if hit is None else (str(100 + hit).zfill(10), titles[hit])
    got = {r.id: r.cik and (r.cik, r.official_name) for r in resolve.resolve_companies(companies, directory).collect()}
    assert got == want


def test_an_empty_title_matches_every_name(spark):
    directory = spark.createDataFrame([(0, "zeta", 5), (1, "", 6)], "ordinal BIGINT, title STRING, cik BIGINT")
    companies = spark.createDataFrame([(1, "acme"), (2, "zeta")], "id BIGINT, name STRING")
    got = {r.id: r.official_name for r in resolve.resolve_companies(companies, directory).collect()}
    assert got == {1: "", 2: "zeta"}


def test_containment_agrees_with_plain_search_and_broadcasts_no_exploded_side(spark):
    rng = random.Random(4)
    names = ["".join(rng.choices("ab c", k=rng.randint(0, 7))) for _ in range(150)] + ["zzz", "é", "Σa", None]
    titles = ["".join(rng.choices("ab cé", k=rng.randint(0, 12))) for _ in range(200)] + ["", None, "ΣA b"]
    companies = spark.createDataFrame(list(enumerate(names)), "id BIGINT, name STRING")
    directory = spark.createDataFrame([(i, i + 1, t) for i, t in enumerate(titles)], "ordinal BIGINT, cik BIGINT, title STRING")
    resolved = resolve.resolve_companies(companies, directory)
    got = {r.id: r.official_name for r in resolved.collect()}
    for i, name in enumerate(names):
        want = None if name is None else next((t for t in titles if t is not None and (t.lower() in name.lower() or name.lower() in t.lower())), None)
        assert got[i] == want, name
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("BroadcastExchange")[1:]:
        assert "Generate" not in part.split("Exchange hashpartitioning")[0].split("BroadcastHashJoin")[0]


def test_the_rarest_gram_leads_to_a_wanted_text(spark):
    texts = spark.createDataFrame([("abcd",), ("abce",), ("abcf xyz",)], "text STRING")
    wanted = spark.createDataFrame([("abcd",), ("abc",), ("cf x",), ("bcz",)], "part STRING")
    assert {tuple(r) for r in resolve.rarest_grams(texts, wanted).collect()} == {("abcd", "bcd", 1), ("abc", "abc", 3), ("cf x", "cf ", 1)}


def test_directory_keeps_document_order(spark):
    payload = '{"9": {"cik_str": 3, "title": "Z"}, "1": {"cik_str": 1, "title": "A"}, "0": {"cik_str": 2, "title": "M"}}'
    df = spark.createDataFrame([(payload,)], "payload STRING")
    got = [(r.ordinal, r.title, r.cik) for r in filing_source.directory_entries(df).orderBy("ordinal").collect()]
    assert got == [(0, "Z", 3), (1, "A", 1), (2, "M", 2)]


def test_company_upsert_fills_only_empty_fields(spark):
    old = spark.createDataFrame(
        [(1, "A", "7", None, T0, T0), (2, "B", "", "Bee", T0, T0)], COMPANIES
    )
    incoming = spark.createDataFrame([("A", "9", "Ay"), ("B", "8", "X"), ("C", None, None), ("C", "5", None)], "name STRING, cik STRING, official_name STRING")
    later = F.lit(dt.datetime(2024, 5, 1))
    got = {r.name: (r.cik, r.official_name) for r in entities.upsert_companies(old, incoming, later).collect()}
    assert got == {"A": ("7", "Ay"), "B": ("8", "Bee"), "C": ("5", None)}


def test_status_completion_creates_missing_rows_and_clears_on_failure(spark):
    companies = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    base = status.initial_status(companies, now())
    log = spark.createDataFrame(
        [(1, T0, True, 4), (1, T0 + dt.timedelta(1), False, 2), (3, T0, True, 5)],
        "company_id BIGINT, at TIMESTAMP, completed BOOLEAN, counted BIGINT",
    )
    got = {r.company_id: (r.stage2_sec_collected, r.stage2_completed_at, r.stage2_rounds_found)
           for r in status.apply_completions(base, log, 2).collect()}
    assert got == {1: (False, None, 2), 2: (False, None, 0), 3: (True, T0, 5)}
    assert set(base.columns) == {f.split()[0] for f in PROCESSING_STATUS.replace("\n", " ").split(", ")}


def test_reset_leaves_stage_one(spark):
    done = status.initial_status(spark.createDataFrame([(1,)], "id BIGINT"), now()).withColumns({
        "stage1_resolved": F.lit(True), "stage2_sec_collected": F.lit(True), "stage3_rounds_found": F.lit(9),
    })
    row = status.reset_status(done, (1, 2, 3, 4)).first()
    assert (row.stage1_resolved, row.stage2_sec_collected, row.stage3_rounds_found) == (True, False, 0)


def test_progress_without_companies_is_zero(spark):
    companies = spark.createDataFrame([], COMPANIES)
    row = status.processing_progress(companies, spark.createDataFrame([], PROCESSING_STATUS)).first()
    assert row.total_companies == 0 and row.stage2_percent == 0.0


def test_rank_within_a_hot_key(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.random(), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE, id INT").repartition(7)
    got = {r.id: r.position for r in ranking.rank_within(df, "k", ["v", "id"]).collect()}
    by_key = {}
    for k, v, i in sorted(rows):
        by_key.setdefault(k, []).append(i)
    assert got == {i: n for ids in by_key.values() for n, i in enumerate(ids, 1)}


def test_priority_fill_spills_to_the_next_provider_and_minute(spark):
    providers = spark.createDataFrame(
        [("slow", 2, 1, True, True), ("fast", 1, 2, True, True), ("off", 0, 9, False, True)],
        "name STRING, priority INT, rate_limit_rpm INT, enabled BOOLEAN, has_api_key BOOLEAN",
    )
    requests = spark.range(1, 8).withColumnRenamed("id", "n")
    got = [(r.minute, r.provider_name) for r in usage.priority_fill(requests, providers, ["n"]).orderBy("n").collect()]
    assert got == [(0, "fast"), (0, "fast"), (0, "slow"), (1, "fast"), (1, "fast"), (1, "slow"), (2, "fast")]
    turns = [r.provider_name for r in usage.round_robin(requests, providers, ["n"]).orderBy("n").collect()]
    assert turns == ["fast", "slow"] * 3 + ["fast"]


def test_close_calls_look_across_slot_borders(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), T0 + dt.timedelta(milliseconds=rng.randrange(20000))) for i in range(300)]
    calls = spark.createDataFrame(rows, "id INT, account STRING, ts TIMESTAMP")
    got = {r.id: r.gap_micros for r in usage.close_calls(calls, "account", 0.1).collect()}
    want = {}
    for account in "ab":
        mine = sorted((t, i) for i, a, t in rows if a == account)
        for (t0, _), (t1, i) in zip(mine, mine[1:]):
            gap = round((t1 - t0).total_seconds() * 1e6)
            if gap < 100_000:
                want[i] = gap
    assert got == want


def test_hits_are_cut_per_query(spark):
    landed = spark.createDataFrame(
        [(1, 1, r, f"t{r}", f"u{r}", None) for r in (3, 1, 2)] + [(1, 2, 1, None, "u1", "b")],
        "company_id BIGINT, query_no INT, rank INT, title STRING, href STRING, body STRING",
    )
    hits = search_source.search_hits(landed, SearchOptions(max_results_per_query=2))
    assert sorted((r.query_no, r.rank, r.title, r.snippet) for r in hits.collect()) == [
        (1, 1, "t1", ""), (1, 2, "t2", ""), (2, 1, "", "b"),
    ]
    assert [(r.url, r.title) for r in rounds.first_hits(hits).orderBy("url").collect()] == [("u1", "t1"), ("u2", "t2")]


def test_user_function_answers_prompts(spark):
    prompts = spark.createDataFrame([(1, "p1"), (2, "p2")], "company_id BIGINT, prompt STRING")
    got = search_source.answer_prompts(prompts, lambda batch: [p.upper() for p in batch])
    assert sorted((r.company_id, r.response) for r in got.collect()) == [(1, "P1"), (2, "P2")]


def test_earlier_duplicates_are_left_alone(spark):
    def row(i, name, dup=False, of=None):
        return (i, 1, name, "2020-01-01", None, None, None, None, "WEB_SEARCH", "LOW", None, None, None, dup, of, None, None)

    df = spark.createDataFrame([row(1, "Seed", True, 9), row(2, "Seed"), row(3, "Seed"), row(4, "Other")], FUNDING_ROUNDS)
    got = {r.id: (r.is_duplicate, r.duplicate_of_id) for r in dedup.deduplicate(df).collect()}
    assert got == {1: (True, 9), 2: (False, None), 3: (True, 2), 4: (False, None)}
    stats = dedup.run_statistics(df).first()
    assert (stats.duplicates_removed, stats.distinct_duplicates, stats.unique_rounds) == (1, 1, 2)
    assert stats.deduplication_rate == 25.0
    marked, again = dedup.deduplicate_with_statistics(df)
    assert again.first() == stats and marked.where("is_duplicate").count() == 2


def test_statistics_join_the_pairs_once(spark):
    empty = spark.createDataFrame([], FUNDING_ROUNDS)
    plan = dedup.run_statistics(empty)._jdf.queryExecution().optimizedPlan().toString()
    pair_joins = [line for line in plan.split("\n") if "Join Inner" in line and "company_id" in line]
    assert len(pair_joins) == 1, plan


def test_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], FUNDING_ROUNDS)
    stats = dedup.run_statistics(empty).first()
    assert (stats.total_companies, stats.total_rounds, stats.deduplication_rate) == (0, 0, 0.0)


def test_thresholds_are_validated():
    with pytest.raises(ValueError):
        DedupOptions(amount_similarity_threshold=1.5)
    with pytest.raises(ValueError):
        DedupOptions(date_proximity_days=-1)


def test_orphans_count_rows_per_missing_key(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "parent_id BIGINT")
    parent = spark.createDataFrame([(1,)], "id BIGINT")
    assert [tuple(r) for r in quality.orphan_keys(child, "parent_id", parent).collect()] == [(5, 2)]


def test_large_tables_are_spread_over_more_tasks(spark, monkeypatch):
    from capledger import session

    rows = spark.range(3000).selectExpr("id % 900 AS key")
    assert session.spread(rows, "key") is rows
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    wide = session.spread(rows, "key")
    assert wide.rdd.getNumPartitions() == 30
    assert max(r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()) < 400
    counted = wide.join(spark.range(0, 900, 2).selectExpr("id AS key"), "key", "left_anti").groupBy("key").count()
    assert {(r.key, r["count"]) for r in counted.collect()} == {(k, 4 if k < 300 else 3) for k in range(1, 900, 2)}


def test_a_cascading_delete_spreads_its_joins(spark, monkeypatch):
    from capledger import session

    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    ids = lambda n, text: spark.range(n).selectExpr(*text.split("; "))
    tables = {
        "companies": ids(9, "id"), "processing_status": ids(9, "id AS company_id"), "funding_rounds": ids(60, "id; id % 9 AS company_id"),
        "round_investors": ids(240, "id % 60 AS round_id; id AS investor_id"), "sources": ids(120, "id; id % 60 AS round_id"),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = quality.delete_companies(tables, spark.range(3))
        plans = {n: kept[n]._jdf.queryExecution().executedPlan().toString() for n in ("round_investors", "sources")}
        assert {n: df.count() for n, df in kept.items()} == {
            "companies": 6, "processing_status": 6, "funding_rounds": 39, "round_investors": 156, "sources": 78,
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(round_id" in plans["sources"] and ", 12)" in plans["sources"] and ", 24)" in plans["round_investors"]
