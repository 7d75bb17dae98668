"""De-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from capledger.checks import shapes
from capledger.checks.registry import query
from capledger.checks.shapes import sql
from capledger.operators import dedup
from capledger.options import DedupOptions

# Sends every company through the plan for very large ones.
ALL_DENSE = DedupOptions(dense_company_rows=0)
EXACT_NAMES = DedupOptions(enable_fuzzy_matching=False)

_LOSERS = sql("SELECT round_id, winner_id FROM t_losers")
_PAIR_COUNTS = sql("SELECT company_id, count(*) AS pairs FROM t_matches GROUP BY company_id")


@query(sql("SELECT company_id, loser_id, winner_id FROM t_matches"))
def duplicate_pairs(spark, root):
    return dedup.matching_pairs(shapes.rounds(spark, root))


@query(_LOSERS)
def duplicate_losers(spark, root):
    return dedup.losers(shapes.rounds(spark, root))


@query(_LOSERS)
def duplicate_losers_dense(spark, root):
    return dedup.losers(shapes.rounds(spark, root), ALL_DENSE)


@query(_PAIR_COUNTS)
def duplicate_pair_counts(spark, root):
    return dedup.pair_counts(shapes.rounds(spark, root))


@query(_PAIR_COUNTS)
def duplicate_pair_counts_dense(spark, root):
    return dedup.pair_counts(shapes.rounds(spark, root), ALL_DENSE)


@query(sql("""
    SELECT loser_id AS round_id, max(winner_id) AS winner_id FROM t_pairs
    WHERE same_name OR same_amount GROUP BY loser_id"""))
def duplicate_losers_exact_names(spark, root):
    return dedup.losers(shapes.rounds(spark, root), EXACT_NAMES)


@query(sql("SELECT id, company_id, round_name, date, is_duplicate, duplicate_of_id FROM t_merged"))
def deduplicated_rounds(spark, root):
    return dedup.deduplicate(shapes.rounds(spark, root)).select(
        "id", "company_id", "round_name", "date", "is_duplicate", "duplicate_of_id"
    )


@query(sql("""
    SELECT company_id, count(*) FILTER (NOT is_duplicate) AS unique_rounds
    FROM t_merged GROUP BY company_id"""))
def unique_rounds_per_company(spark, root):
    return dedup.unique_rounds_per_company(dedup.deduplicate(shapes.rounds(spark, root)))


@query(sql("SELECT DISTINCT company_id FROM t_rounds"))
def companies_with_rounds(spark, root):
    return dedup.companies_with_rounds(shapes.rounds(spark, root))


@query(sql("""
    SELECT * FROM t_losers WHERE round_id IN (SELECT id FROM t_rounds WHERE company_id NOT IN
      (SELECT company_id FROM t_status WHERE stage4_merged))"""))
def pending_duplicate_losers(spark, root):
    pending = dedup.pending_rounds(shapes.rounds(spark, root), shapes.status(spark, root))
    return dedup.losers(pending)


_STATISTICS = sql("""
    SELECT (SELECT count(DISTINCT company_id) FROM t_rounds) AS total_companies,
           (SELECT count(*) FROM t_rounds) AS total_rounds,
           (SELECT count(*) FROM t_merged WHERE NOT is_duplicate) AS unique_rounds,
           (SELECT count(*) FROM t_matches) AS duplicates_removed,
           (SELECT count(*) FROM t_losers) AS distinct_duplicates,
           round(100.0 * (SELECT count(*) FROM t_matches) / (SELECT count(*) FROM t_rounds), 6)
             AS deduplication_rate""")


@query(_STATISTICS)
def deduplication_statistics(spark, root):
    stats = dedup.run_statistics(shapes.rounds(spark, root))
    return stats.withColumn("deduplication_rate", F.round("deduplication_rate", 6))


@query(_STATISTICS)
def mixed_density_statistics(spark, root):
    """The statistics of a marking run in which large companies take the dense plan and the others the ordinary one."""
    marked, stats = dedup.deduplicate_with_statistics(shapes.rounds(spark, root), DedupOptions(dense_company_rows=12))
    # The marked rounds are counted again: both results come from one pair join.
    unique = marked.agg(F.count_if(~F.col("is_duplicate")).alias("unique_rounds"))
    return stats.withColumn("unique_rounds", unique.scalar()).withColumn("deduplication_rate", F.round("deduplication_rate", 6))


@query(_LOSERS)
def duplicate_losers_sliced(spark, root):
    """The dense plan with the runs of companies of more than eight rounds cut into slices."""
    return dedup.losers(shapes.rounds(spark, root), DedupOptions(dense_company_rows=0, slice_rows=8))


@query(_PAIR_COUNTS)
def duplicate_pair_counts_sliced(spark, root):
    return dedup.pair_counts(shapes.rounds(spark, root), DedupOptions(dense_company_rows=0, slice_rows=8))


_ONE_COMPANY = {"t_rounds": shapes.SQL["t_rounds"].replace("o_custkey AS company_id", "CAST(1 AS BIGINT) AS company_id")}
ONE_COMPANY = DedupOptions(slice_rows=2000)


@query(sql("SELECT round_id, winner_id FROM t_losers", _ONE_COMPANY))
def one_company_losers(spark, root):
    """All rounds belong to one company: dense, and cut into slices."""
    return dedup.losers(shapes.rounds(spark, root).withColumn("company_id", F.lit(1).cast("bigint")), ONE_COMPANY)


@query(sql("SELECT company_id, count(*) AS pairs FROM t_matches GROUP BY company_id", _ONE_COMPANY))
def one_company_pair_counts(spark, root):
    return dedup.pair_counts(shapes.rounds(spark, root).withColumn("company_id", F.lit(1).cast("bigint")), ONE_COMPANY)


@query(_LOSERS)
def duplicate_losers_mixed(spark, root):
    """Both plans in one run: companies of more than twelve dated rounds take the dense one."""
    return dedup.losers(shapes.rounds(spark, root), DedupOptions(dense_company_rows=12))
