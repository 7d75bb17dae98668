"""Fuzzy de-duplication of the rounds of a company, with one surviving record per match.

Two rounds of a company match when their dates are close and either their amounts are
similar or their names match. The better round of a matching pair is decided by a strict
total order: HIGH confidence first, then the more complete record, then the lower id. A
round is a duplicate when any better round matches it, and it then points at the matching
better round with the largest id.

Two exact plans share the work, chosen per company by its number of dated rounds:

* up to ``dense_company_rows``: one equi-join on the company with residual predicates, so a
  round meets a bounded number of others;
* above that, by windows of dates: rounds whose windows hold few others meet these directly, at most
  ``window_rows`` in each of two windows; for the others ``operators.dense``, whose cost does not depend on
  the number of matching pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from capledger.functions.dates import day_number, parsed_date
from capledger.functions.numbers import comparable_amount, completeness
from capledger.functions.text import keyword_mask, normalized_name
from capledger.operators import dense
from capledger.options import DedupOptions
from capledger.session import ROWS_PER_TASK, kept, materialize, sized

DEFAULTS = DedupOptions()
BROADCAST_COMPANIES = 1_000_000  # ids, some 16 MB; more of them are joined by shuffle
BROADCAST_WINDOWS = 200_000


def match_features(rounds: DataFrame, options: DedupOptions = DEFAULTS) -> DataFrame:
    """What matching needs of each open, dated round: a few narrow columns.

    ``tier`` orders records from best (0) to worst (9): confidence, then completeness.
    ``name_key`` is set where equality of the whole name decides, ``mask`` where keywords do.
    """
    name = normalized_name(F.col("round_name"))
    name_mask = keyword_mask(F.col("name")) if options.enable_fuzzy_matching else F.lit(0)
    facts = completeness(
        F.col("amount_raised_usd"), F.col("pre_money_valuation_usd"),
        F.col("post_money_valuation_usd"), F.col("lead_investor"),
    )
    not_high = F.when(F.col("confidence_score") == "HIGH", 0).otherwise(5)
    day = day_number(parsed_date(F.col("date")))
    # Exploding one-element arrays keeps the costly expressions out of the filters that the
    # optimizer derives from joins on them: each is evaluated once per round.
    return (
        rounds.where(~F.col("is_duplicate"))
        .select(
            "id",
            "company_id",
            F.explode(F.array(day)).alias("day"),
            comparable_amount(F.col("amount_raised_usd")).alias("amount"),
            (not_high + 4 - facts).cast("int").alias("tier"),
            name.alias("name"),
        )
        .where(F.col("day").isNotNull())
        .select("*", F.explode(F.array(F.struct(
            name_mask.alias("mask"), F.when(name_mask == 0, F.col("name")).alias("name_key")
        ))).alias("names"))
        .select("id", "company_id", "day", "amount", "names.mask", "names.name_key", "tier")
    )


def _rounds_match(options: DedupOptions) -> Column:
    close = F.abs(F.col("a.day") - F.col("b.day")) <= options.date_proximity_days
    keyword = F.col("a.mask").bitwiseAND(F.col("b.mask")) != 0
    name = F.coalesce(F.col("a.name_key") == F.col("b.name_key"), F.lit(False))
    # Comparable amounts are never zero, and a negative ratio is below any threshold.
    larger = F.greatest("a.amount", "b.amount")
    ratio = F.abs(F.col("a.amount") - F.col("b.amount")) / larger
    amount = F.coalesce(ratio <= options.amount_similarity_threshold, F.lit(False))
    return close & (keyword | name | amount)


def _losing_first(pairs: DataFrame) -> DataFrame:
    """Order each pair of ``a`` (lower id) and ``b`` into loser and winner."""
    first_wins = F.col("a.tier") <= F.col("b.tier")
    return pairs.select(
        F.col("a.company_id").alias("company_id"),
        F.when(first_wins, F.col("b.id")).otherwise(F.col("a.id")).alias("loser_id"),
        F.when(first_wins, F.col("a.id")).otherwise(F.col("b.id")).alias("winner_id"),
    )


def split_by_density(
    rounds: DataFrame, options: DedupOptions
) -> tuple[DataFrame, DataFrame | None]:
    """(features of ordinary companies, features of dense companies or None if there are none).

    Counts open rounds per company in one job over two columns. Dense companies are the
    exception: only when some exist are their features written beside the checkpoints, as
    several steps read them. The list of dense companies is counted, and broadcast when short.
    """
    dense_companies = materialize(
        rounds.where(~F.col("is_duplicate")).groupBy("company_id").count()
        .where(F.col("count") > options.dense_company_rows)
    )
    features = match_features(rounds, options)
    how_many, n_rounds = dense_companies.agg(F.count("*"), F.sum("count")).first()
    if how_many == 0:
        return features, None
    dense_companies = dense_companies.select("company_id")
    if how_many <= BROADCAST_COMPANIES:
        dense_companies = F.broadcast(dense_companies)
    ordinary = features.join(dense_companies, "company_id", "left_anti")
    crowded = features.join(dense_companies, "company_id", "left_semi")
    # Each of these rounds is expanded many times over: every task is to read some of them.
    tasks = rounds.sparkSession.sparkContext.defaultParallelism
    return ordinary, kept(crowded, min(ROWS_PER_TASK, math.ceil(n_rounds / tasks)))


def _direct_pairs(ordinary: DataFrame, options: DedupOptions) -> DataFrame:
    condition = (
        (F.col("a.company_id") == F.col("b.company_id"))
        & (F.col("a.id") < F.col("b.id"))
        & _rounds_match(options)
    )
    # Both sides need the same shuffle on the company, which is then done once.
    return _losing_first(ordinary.alias("a").join(ordinary.hint("merge").alias("b"), condition))


def _pairs_by_window(crowded: DataFrame, options: DedupOptions) -> tuple[DataFrame, DataFrame | None]:
    """(matching pairs that meet in windows of few rounds, features of all rounds in crowded windows or None).

    Dates lie in blocks that are as long as close dates can be apart, and a window is a block with the one before it, so two
    close rounds meet in the window of the later block. A round is in two windows; if one of them is crowded, it is in
    the second frame. Pairs of two such rounds are left to it, all others are in the first.
    """
    placed = crowded.withColumn("block", F.floor(F.col("day") / (options.date_proximity_days + 1)))
    windows = (
        placed.groupBy("company_id", "block").agg(F.count("*").alias("n"))
        .select("company_id", "n", F.explode(F.array(F.col("block"), F.col("block") + 1)).alias("window"))
        .groupBy("company_id", "window").agg(F.sum("n").alias("n"))
        .where(F.col("n") > options.window_rows).select("company_id", "window")
    )
    windows = materialize(windows)
    how_many, rest = windows.count(), None
    if how_many == 0:
        placed = placed.withColumns({"own": F.lit(False), "next": F.lit(False)})
    else:
        for name, step in (("own", 0), ("next", 1)):
            flagged = windows.select("company_id", (F.col("window") - step).alias("block"), F.lit(True).alias(name))
            if how_many <= BROADCAST_WINDOWS:
                flagged = F.broadcast(flagged)
            placed = placed.join(flagged, ["company_id", "block"], "left").withColumn(name, F.coalesce(name, F.lit(False)))
        rest = placed.where(F.col("own") | F.col("next")).select(crowded.columns)
        if how_many > BROADCAST_WINDOWS:
            rest = kept(rest)
    met = placed.withColumn("left_out", F.col("own") | F.col("next")).select(
        *crowded.columns, "block", "left_out", F.explode(F.array_compact(F.array(
            F.when(~F.col("own"), F.col("block")), F.when(~F.col("next"), F.col("block") + 1)
        ))).alias("window"),
    )
    condition = (
        (F.col("a.company_id") == F.col("b.company_id"))
        & (F.col("a.window") == F.col("b.window"))
        & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.window") == F.greatest("a.block", "b.block"))
        & ~(F.col("a.left_out") & F.col("b.left_out"))
        & _rounds_match(options)
    )
    return _losing_first(met.alias("a").join(met.hint("merge").alias("b"), condition)), rest


def _pairs_and_rest(rounds: DataFrame, options: DedupOptions) -> tuple[DataFrame, DataFrame | None]:
    """(company_id, loser_id, winner_id) of all pairs that are formed, and features of the rounds left to ``operators.dense``."""
    ordinary, crowded = split_by_density(rounds, options)
    pairs = _direct_pairs(ordinary, options)
    if crowded is None:
        return pairs, None
    near, rest = _pairs_by_window(crowded, options)
    return pairs.unionByName(near), rest


def matching_pairs(rounds: DataFrame, options: DedupOptions = DEFAULTS) -> DataFrame:
    """Every matching pair as (company_id, loser_id, winner_id).

    A listing for review: its size is the number of matches. Nothing else in the library
    reads it. Dense companies are joined on (company, shared facet, date block) so that only
    near rounds meet, and a pair sharing several facets is kept once, at the first of them.
    """
    ordinary, crowded = split_by_density(rounds, options)
    if crowded is None:
        return _direct_pairs(ordinary, options)
    blocks = dense.blocked(crowded, options)
    condition = (
        (F.col("a.company_id") == F.col("b.company_id"))
        & (F.col("a.facet") == F.col("b.facet"))
        & (F.col("a.block") == F.col("b.block"))
        & (F.col("a.id") < F.col("b.id"))
        & _rounds_match(options)
        & (F.col("a.facet") == F.array_min(F.array_intersect("a.facets", "b.facets")))
        & (F.col("a.block") == F.array_min(F.array_intersect("a.blocks", "b.blocks")))
    )
    crowded_pairs = _losing_first(blocks.alias("a").join(blocks.alias("b"), condition))
    return _direct_pairs(ordinary, options).unionByName(crowded_pairs)


def losers_with_matches(
    rounds: DataFrame, options: DedupOptions = DEFAULTS
) -> tuple[DataFrame, DataFrame | None]:
    """(round_id, winner_id, matches) of every loser, and the pairs per company that were not formed.

    ``matches`` counts the better rounds that a round was seen to match; pairs in crowded windows of dense companies are
    counted as a whole, in the second frame (company_id, pairs).
    """
    pairs, rest = _pairs_and_rest(rounds, options)
    found = pairs.select(
        F.col("loser_id").alias("round_id"), "winner_id", F.lit(1).cast("bigint").alias("matches")
    )
    if rest is not None:
        candidates = dense.winner_candidates(rest, options)
        found = found.unionByName(candidates.withColumn("matches", F.lit(0).cast("bigint")))
    lost = found.groupBy("round_id").agg(F.max("winner_id").alias("winner_id"), F.sum("matches").alias("matches"))
    return lost, None if rest is None else dense.pair_counts(rest, options)


def losers(rounds: DataFrame, options: DedupOptions = DEFAULTS) -> DataFrame:
    """(round_id, winner_id) of every round that a better round duplicates."""
    pairs, rest = _pairs_and_rest(rounds, options)
    candidates = pairs.select(F.col("loser_id").alias("round_id"), "winner_id")
    if rest is not None:
        candidates = candidates.unionByName(dense.winner_candidates(rest, options))
    return candidates.groupBy("round_id").agg(F.max("winner_id").alias("winner_id"))


def pair_counts(rounds: DataFrame, options: DedupOptions = DEFAULTS) -> DataFrame:
    """(company_id, pairs): number of matching pairs per company that has any."""
    pairs, rest = _pairs_and_rest(rounds, options)
    counted = pairs.groupBy("company_id").agg(F.count("*").alias("pairs"))
    if rest is None:
        return counted
    both = counted.unionByName(dense.pair_counts(rest, options))
    return both.groupBy("company_id").agg(F.sum("pairs").alias("pairs"))


def mark_duplicates(rounds: DataFrame, losers_df: DataFrame) -> DataFrame:
    """``rounds`` with flag and pointer set where ``losers_df`` names a round."""
    marks = losers_df.select(F.col("round_id").alias("id"), "winner_id")
    lost = F.col("winner_id").isNotNull()
    return (
        rounds.join(marks, "id", "left")
        .withColumn("is_duplicate", F.col("is_duplicate") | lost)
        .withColumn("duplicate_of_id", F.coalesce("winner_id", "duplicate_of_id"))
        .drop("winner_id")
        .select(rounds.columns)
    )


def deduplicate(rounds: DataFrame, options: DedupOptions = DEFAULTS) -> DataFrame:
    """All rounds, duplicates marked. Rounds marked earlier are left alone and never compared."""
    return mark_duplicates(rounds, losers(rounds, options))


def unique_rounds_per_company(rounds: DataFrame) -> DataFrame:
    return rounds.groupBy("company_id").agg(
        F.count_if(~F.col("is_duplicate")).alias("unique_rounds")
    )


def companies_with_rounds(rounds: DataFrame) -> DataFrame:
    return rounds.select("company_id").distinct()


def pending_rounds(rounds: DataFrame, status: DataFrame) -> DataFrame:
    """Rounds of companies whose merge stage is not done."""
    done = status.where(F.col("stage4_merged")).select("company_id")
    return rounds.join(sized(done), "company_id", "left_anti").select(rounds.columns)


def deduplicate_with_statistics(
    rounds: DataFrame, options: DedupOptions = DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """All rounds with duplicates marked, and one row about the run; pairs are joined once for both.

    ``duplicates_removed`` counts matching pairs, so the rate may pass 100 percent;
    ``distinct_duplicates`` counts the rounds newly marked.
    """
    lost, dense_pairs = losers_with_matches(rounds, options)
    lost = materialize(lost)
    return mark_duplicates(rounds, lost), _statistics(rounds, lost, dense_pairs)


def run_statistics(rounds: DataFrame, options: DedupOptions = DEFAULTS) -> DataFrame:
    """The same row without marking anything: one pair join, and one pass over three columns of the rounds."""
    return _statistics(rounds, *losers_with_matches(rounds, options))


def _statistics(rounds: DataFrame, lost: DataFrame, dense_pairs: DataFrame | None) -> DataFrame:
    totals = (
        rounds.groupBy("company_id")
        .agg(F.count("*").alias("n_rounds"), F.count_if(F.col("is_duplicate")).alias("n_earlier"))
        .agg(
            F.count("*").alias("total_companies"),
            F.coalesce(F.sum("n_rounds"), F.lit(0)).alias("total_rounds"),
            F.coalesce(F.sum("n_earlier"), F.lit(0)).alias("earlier_duplicates"),
        )
    )
    counted = lost.select(F.lit(1).cast("bigint").alias("losers"), "matches")
    if dense_pairs is not None:
        counted = counted.unionByName(dense_pairs.select(F.lit(0).cast("bigint").alias("losers"), F.col("pairs").alias("matches")))
    found = counted.agg(
        F.coalesce(F.sum("losers"), F.lit(0)).alias("distinct_duplicates"),
        F.coalesce(F.sum("matches"), F.lit(0)).alias("duplicates_removed"),
    )
    one = F.lit(1).alias("one")
    joined = totals.select("*", one).join(found.select("*", one), "one")
    rate = F.coalesce(F.try_divide(F.col("duplicates_removed") * 100.0, F.col("total_rounds")), F.lit(0.0))
    return joined.select(
        "total_companies",
        "total_rounds",
        (F.col("total_rounds") - F.col("earlier_duplicates") - F.col("distinct_duplicates")).alias("unique_rounds"),
        "duplicates_removed",
        "distinct_duplicates",
        rate.alias("deduplication_rate"),
    )
