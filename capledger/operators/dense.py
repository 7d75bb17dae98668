"""De-duplication of companies with very many rounds, without enumerating their pairs.

One company may own a large part of all rounds, and inside it a name or an amount may be
shared by most of them, so the number of matching pairs can be quadratic. The transforms here
give exactly the winners and pair counts that a pair listing would, from sorted runs and
aggregates only. Input is ``dedup.match_features`` of the dense companies.

Terms
  facet   a value whose holders match each other as soon as their dates are close: a keyword,
          a whole name, a logarithmic amount bucket, or "negative amount".
  bucket  amounts of one bucket are similar to each other by construction (its width is just
          below the similarity threshold); similar amounts are at most two buckets apart.
  block   dates in blocks of ``date_proximity_days + 1`` days: dates of one block are close,
          close dates are at most one block apart.
  cell    facet x block (x tier): all its members match each other.

Winners are the largest id of three kinds of candidates
  1. better tier, shared facet: largest id per (facet, day, tier), then a date-range window
     over at most one row per calendar day, looked up by each round's names, amount bucket and day;
  2. same tier, smaller id: the previous member of a shared cell, or a round of a neighbouring
     cell that falls between that member and this round. Ids between two consecutive members
     belong to one gap only, so each round is tried against one member per neighbouring cell;
  3. better tier, amounts similar across a bucket border: the date range is split into a
     fixed number of aligned nodes, and inside each node a running maximum in amount order
     answers "largest id up to this amount".

The first kind comes from aggregates alone and is ``known`` of each round before the other two, whose sorted runs hold
several rows per round. A round takes part in these only if it can still gain: it asks for a smaller id of its
tier if that may be larger than what is known, and across a bucket border if a neighbour bucket holds a larger id within its
days. Rounds answer only if their id is larger than what is known to some round that asks near them. Of a large company
the known winners are mostly near the largest ids, so that few rounds are left in the runs.

Runs of companies above ``slice_rows`` are cut into slices (ranges of ids or amounts, as many as the company's
own size asks for) whose summaries are carried over, so that no task has to hold a whole cell of them. Without such
companies nothing is cut or carried.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from capledger.functions.numbers import amounts_are_similar
from capledger.functions.text import ROUND_KEYWORDS
from capledger.options import DedupOptions
from capledger.session import ROWS_PER_TASK, kept, materialize

TIERS = range(9)
ID_STRIDE = 16
AMOUNT_SLICES = 64
BROADCAST_CUT = 10_000  # companies with 255 bounds each, some 20 MB
LOOKUP_ROWS = 200_000  # rows with up to 18 ids each, some 50 MB; larger lookups are joined by shuffle
VISITS = 16  # rows of a round in the cells it visits, about
_LEAST = -(1 << 63)
_BIG = "decimal(38,0)"


class _Grid:
    """Bucket and block arithmetic for one set of options."""

    def __init__(self, options: DedupOptions):
        self.days = options.date_proximity_days
        self.threshold = options.amount_similarity_threshold
        self.block_days = self.days + 1
        self.levels = (self.block_days - 1).bit_length()
        exact = -math.log1p(-self.threshold)
        self.width, self.reach = exact * (1 - 1e-9), exact * (1 + 1e-9)

    @property
    def tolerant(self) -> bool:
        return self.threshold > 0

    def place(self, df: DataFrame) -> DataFrame:
        """Add ``block, offset`` of ``day`` and the buckets of ``amount``.

        ``lowest`` to ``highest`` are the buckets a similar amount can have.
        """
        w, r = self.width, self.reach
        placed = df.withColumns({
            "block": F.expr(f"floor(day / {self.block_days})"),
            "offset": F.expr(f"pmod(day, {self.block_days})"),
            "positive": F.expr("coalesce(amount > 0, false)"),
        })
        if not self.tolerant:
            return placed
        return placed.withColumns({
            "bucket": F.expr(f"CASE WHEN amount > 0 THEN floor(ln(amount) / {w!r}D) END"),
            "lowest": F.expr(f"CASE WHEN amount > 0 THEN floor((ln(amount) - {r!r}D) / {w!r}D) END"),
            "highest": F.expr(f"CASE WHEN amount > 0 THEN floor((ln(amount) + {r!r}D) / {w!r}D) END"),
        })

    def amount_facet(self, bucket: Column | None = None) -> Column:
        if not self.tolerant:
            return F.concat(F.lit("a:"), F.col("amount").cast("string"))
        return F.concat(F.lit("a:"), (F.col("bucket") if bucket is None else bucket).cast("string"))

    def amount_range(self) -> tuple[Column, Column]:
        """Smallest and largest double that is similar to ``amount``.

        The quotient estimate is within a few units in the last place of the true limit, so
        the neighbouring doubles are tried with the similarity rule itself.
        """
        def limit(estimate: str, rule: str, pick: str) -> Column:
            near = [f"({estimate} + {estimate} * ({k} * {2.0 ** -53!r}D))" for k in range(-8, 9)]
            return F.expr(f"{pick}({', '.join(f'CASE WHEN {rule.format(x=x)} <= {self.threshold!r}D THEN {x} END' for x in near)})")

        keep = f"(1 - {self.threshold!r}D)"
        return (
            limit(f"(amount * {keep})", "(amount - {x}) / amount", "least"),
            limit(f"(amount / {keep})", "({x} - amount) / {x}", "greatest"),
        )

    def cuts(self, level: str) -> str:
        """Slices of a bucket at a level: a node of half the days has half as many, those of a day or two have one."""
        return f"greatest(1, shiftright({AMOUNT_SLICES}, {self.levels} - {level}))"

    def node(self, block: str, node: str) -> str:
        """A node of ``level`` as one number: its block, and its place among the nodes of all levels."""
        return f"CAST(({block}) * {2 ** (self.levels + 1)} + shiftleft(1, {self.levels} - level) + {node} AS BIGINT)"

    def own_node(self) -> str:
        """The aligned date node of ``level`` that holds this day."""
        return self.node("block", "shiftright(offset, level)")

    def near_node(self) -> str:
        """The node of ``level`` among disjoint ones that together hold exactly the close days.

        The own block is close as a whole. Of the next block the days before this offset are
        close (the set bits of the offset name their nodes), of the block before it the days
        after this offset (the clear bits).
        """
        later = self.node("block + 1", "shiftright(offset, level) - 1")
        earlier = self.node("block - 1", "shiftright(offset, level) + 1")
        return (
            f"CASE WHEN level = {self.levels} THEN {self.node('block', '0')} "
            f"WHEN (shiftright(offset, level) & 1) = 1 THEN {later} ELSE {earlier} END"
        )


def _name_facets() -> Column:
    keywords = F.expr(
        f"transform(filter(sequence(0, {len(ROUND_KEYWORDS) - 1}), bit -> "
        "shiftright(mask, bit) & 1 = 1), bit -> concat('k', bit))"
    )
    whole = F.when(F.col("name_key").isNotNull(), F.concat(F.lit("n:"), F.col("name_key")))
    negative = F.when(F.coalesce(F.col("amount") < 0, F.lit(False)), F.lit("m"))
    return F.concat(keywords, F.array_compact(F.array(whole, negative)))


def _facets(grid: _Grid) -> Column:
    amount = F.when(F.col("positive"), grid.amount_facet())
    return F.concat(_name_facets(), F.array_compact(F.array(amount)))


def blocked(features: DataFrame, options: DedupOptions) -> DataFrame:
    """One row per (facet, block) under which a matching partner may be met."""
    grid = _Grid(options)
    if grid.tolerant:
        amounts = F.when(
            F.col("positive"),
            F.transform(F.sequence("bucket", "highest"), lambda b: grid.amount_facet(b)),
        ).otherwise(F.array().cast("array<string>"))
        facets = F.concat(_name_facets(), amounts)
    else:
        facets = _facets(grid)
    return (
        grid.place(features).withColumn("facets", facets)
        .withColumn("blocks", F.expr("array(block, block + 1)"))
        .drop("block")
        .withColumn("facet", F.explode("facets"))
        .withColumn("block", F.explode("blocks"))
    )


# ---------------------------------------------------------------- winners


def _top_id_per_tier() -> list[Column]:
    return [F.max(F.when(F.col("tier") == t, F.col("id"))).alias(f"top{t}") for t in TIERS]


def _top_ids_better_than() -> list[Column]:
    """Column ``better{t}``: largest id among tiers better than t, for t = 1..9."""
    tops = [F.col(f"top{t}") for t in TIERS]
    return [
        (tops[0] if t == 1 else F.greatest(*tops[:t])).alias(f"better{t}") for t in range(1, 10)
    ]


def _for_own_tier(best: str) -> Column:
    """The entry of ``best`` that belongs to this round's tier (none for tier 0)."""
    return F.get(best, F.col("tier") - 1)


def _merged_bests() -> Column:
    """``better1`` to ``better9`` of several rows as one array."""
    return F.array(*[F.max(f"better{t}") for t in range(1, 10)])


def _lookup(df: DataFrame) -> DataFrame:
    """``df`` evaluated once, and broadcast by joins if it has few rows."""
    table = kept(df)
    return F.broadcast(table) if table.count() <= LOOKUP_ROWS else table.hint("merge")


def _spot(grid: _Grid) -> Column:
    """What rounds of similar amounts share: their bucket, without tolerance the amount itself."""
    return F.when(F.col("positive"), F.col("bucket" if grid.tolerant else "amount"))


_NAMED = ["mask", "name_key", "negative"]


def _better_by_name(placed: DataFrame, grid: _Grid) -> DataFrame:
    """(company_id, day, mask, name_key, negative, best): largest ids of better tiers under any facet of these names."""
    keys, facet = ["company_id", "day", *_NAMED], ["company_id", "facet"]
    near = Window.partitionBy(*facet).orderBy("day").rangeBetween(-grid.days, grid.days)
    tops = placed.groupBy(*keys).agg(*_top_id_per_tier()).withColumn(
        "amount", F.when(F.col("negative"), F.lit(-1.0))
    ).withColumn("facet", F.explode(_name_facets())).drop("amount")
    per_day = tops.groupBy(*facet, "day").agg(*[F.max(f"top{t}").alias(f"top{t}") for t in TIERS])
    best = per_day.select(*facet, "day", *_top_ids_better_than()).select(
        *facet, "day", *[F.max(f"better{t}").over(near).alias(f"better{t}") for t in range(1, 10)]
    )
    return tops.select(*keys, "facet").join(best, [*facet, "day"]).groupBy(*keys).agg(_merged_bests().alias("by_name"))


def _better_by_amount(placed: DataFrame, grid: _Grid) -> DataFrame:
    """(company_id, day, spot, by_amount, beside): largest ids of better tiers of this bucket, and of the two beside it."""
    keys = ["company_id", "spot", "day"]
    near = Window.partitionBy("company_id", "spot").orderBy("day").rangeBetween(-grid.days, grid.days)
    tops = placed.where("positive").groupBy(*keys).agg(*_top_id_per_tier())
    if grid.tolerant:
        # The buckets beside are asked at days on which they hold nothing, too.
        both = tops.withColumn("step", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
        own = F.col("step") == 0
        tops = both.withColumn("spot", F.col("spot") + F.col("step")).groupBy(*keys).agg(
            *[F.max(F.when(own, F.col(f"top{t}"))).alias(f"top{t}") for t in TIERS]
        )
    best = tops.select(*keys, *_top_ids_better_than()).select(
        *keys, *[F.max(f"better{t}").over(near).alias(f"better{t}") for t in range(1, 10)]
    )
    if not grid.tolerant:
        return best.select(*keys, F.array(*[f"better{t}" for t in range(1, 10)]).alias("by_amount"), F.lit(None).cast("array<bigint>").alias("beside"))
    stepped = best.withColumn("step", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).withColumn("spot", F.col("spot") + F.col("step"))
    return stepped.groupBy(*keys).agg(
        F.array(*[F.max(F.when(F.col("step") == 0, F.col(f"better{t}"))) for t in range(1, 10)]).alias("by_amount"),
        F.array(*[F.max(F.when(F.col("step") != 0, F.col(f"better{t}"))) for t in range(1, 10)]).alias("beside"),
    ).join(placed.where("positive").select(*keys).distinct(), keys, "left_semi")


def _with_known(features: DataFrame, grid: _Grid) -> DataFrame:
    """Add ``known``, the largest id of a better tier that shares a facet, and ``beside``: no id of a better tier whose amount
    is similar across a bucket border is larger."""
    placed = grid.place(features).withColumn("spot", _spot(grid)).withColumn("negative", F.coalesce(F.col("amount") < 0, F.lit(False)))
    names = _lookup(_better_by_name(placed, grid))
    amounts = _lookup(_better_by_amount(placed, grid))
    same = [placed[c].eqNullSafe(names[c]) for c in _NAMED] + [placed[c] == names[c] for c in ("company_id", "day")]
    found = placed.join(names, reduce(Column.__and__, same), "left").select(placed["*"], "by_name").join(
        amounts, ["company_id", "spot", "day"], "left"
    )
    beside = _for_own_tier("beside")
    if grid.tolerant:
        # At the edge of a bucket rounding may reach a bucket further.
        further = (F.col("lowest") < F.col("bucket") - 1) | (F.col("highest") > F.col("bucket") + 1)
        beside = F.when(further & (F.col("tier") > 0), F.lit((1 << 63) - 1)).otherwise(beside)
    return kept(found.select(
        *features.columns, F.greatest(_for_own_tier("by_name"), _for_own_tier("by_amount")).alias("known"), beside.alias("beside"),
    ))


def _large_companies(features: DataFrame, options: DedupOptions) -> DataFrame | None:
    """(company_id, n_slices, bounds) of the companies whose runs are cut; None if there are none.

    ``bounds`` are quantiles of the company's own ids.
    """
    large = materialize(
        features.groupBy("company_id").agg(F.count("*").alias("n")).where(F.col("n") > options.slice_rows)
    )
    if large.isEmpty():
        return None
    points = ID_STRIDE * ID_STRIDE
    quantiles = F.percentile_approx("id", [i / points for i in range(1, points)], 10 * points).alias("bounds")
    n_slices = F.least(F.lit(points), F.ceil(F.col("n") / options.slice_rows)).cast("int")
    bounds = features.join(large.select("company_id"), "company_id", "left_semi").groupBy("company_id").agg(quantiles)
    cut = materialize(large.join(bounds, "company_id").select("company_id", n_slices.alias("n_slices"), "bounds"))
    return F.broadcast(cut) if cut.count() <= BROADCAST_CUT else cut


def _with_id_slice(features: DataFrame, large: DataFrame | None) -> DataFrame:
    """Add ``slice``: which id range of about equal size of its company holds the id; 0 where runs are not cut."""
    if large is None:
        return features.withColumn("slice", F.lit(0))
    coarse = f"size(filter(sequence(1, {ID_STRIDE - 1}), i -> bounds[i * {ID_STRIDE} - 1] <= id))"
    fine = f"slice(bounds, coarse * {ID_STRIDE} + 1, {ID_STRIDE - 1})"
    place = f"coarse * {ID_STRIDE} + size(filter({fine}, b -> b <= id))"
    return (
        features.join(large, "company_id", "left")
        .withColumn("coarse", F.expr(coarse))
        .withColumn("slice", F.expr(
            f"CASE WHEN bounds IS NULL THEN 0 ELSE ({place}) * n_slices DIV {ID_STRIDE * ID_STRIDE} END"
        ))
        .drop("bounds", "coarse", "n_slices")
    )


def _visited(grid: _Grid) -> Column:
    """All cells that a round belongs to (``own``) or borders on."""
    def visits(facet: Column, own_facet: Column) -> Column:
        return F.array(*[
            F.struct(
                facet.alias("facet"), (F.col("block") + step).alias("block"),
                (own_facet if step == 0 else F.lit(False)).alias("own"),
            )
            for step in (-1, 0, 1)
        ])

    by_name = F.flatten(F.transform(_name_facets(), lambda f: visits(f, F.lit(True))))
    if grid.tolerant:
        by_amount = F.flatten(F.transform(
            F.sequence("lowest", "highest"), lambda b: visits(grid.amount_facet(b), b == F.col("bucket"))
        ))
    else:
        by_amount = visits(grid.amount_facet(), F.lit(True))
    return F.when(F.col("positive"), F.concat(by_name, by_amount)).otherwise(by_name)


_CELL = ["company_id", "tier", "facet", "block"]


def _of_same_tier(known: DataFrame, grid: _Grid) -> DataFrame:
    """The rounds that may gain by a smaller id of their tier, and those whose id one of them may gain.

    These are told by block: ids between the least that is known to a round that asks in this block or one beside it, and
    the largest id of such rounds.
    """
    placed = known.withColumn("block", F.expr(f"floor(day / {grid.block_days})"))
    asking = placed.where(~F.coalesce(F.col("known") >= F.col("id"), F.lit(False))).select(
        "company_id", "tier", F.explode(F.array(*[F.col("block") + step for step in (-1, 0, 1)])).alias("block"), "known", "id",
    )
    span = asking.groupBy("company_id", "tier", "block").agg(
        F.min(F.coalesce("known", F.lit(_LEAST))).alias("above"), F.max("id").alias("up_to"),
    )
    return kept(
        placed.join(_lookup(span), ["company_id", "tier", "block"])
        .where((F.col("id") > F.col("above")) & (F.col("id") <= F.col("up_to")))
        .select("company_id", "tier", "id", "day", "amount", "mask", "name_key")
    )


def _same_tier_previous(rounds: DataFrame, grid: _Grid, large: DataFrame | None) -> DataFrame:
    # ``place`` is 0 for rounds, -1 and 1 for what is carried into the slice from below and from above.
    rows = _with_id_slice(rounds, large).withColumns({
        "place": F.lit(0), "facet": F.lit(None).cast("string"), "in_block": F.lit(None).cast("bigint"),
    })
    if large is not None:
        carried = _carried(rounds, grid, large).withColumnRenamed("block", "in_block")
        rows = rows.unionByName(carried.withColumns({"mask": F.lit(0), "name_key": F.lit(None).cast("string")}).select(rows.columns))
    # A slice is brought together before its rounds visit their cells, so that visits are sorted but never shuffled.
    tasks = max(int(rounds.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rounds.count() * VISITS / ROWS_PER_TASK))
    together = grid.place(rows.repartition(tasks, "company_id", "slice"))
    carried_to = F.array(F.struct("facet", F.col("in_block").alias("block"), F.lit(True).alias("own")))
    visits = together.select(
        "company_id", "tier", "id", "day", "amount", "slice", "place",
        F.explode(F.when(F.col("place") == 0, _visited(grid)).otherwise(carried_to)).alias("visit"),
    ).select("company_id", "tier", "visit.*", "slice", "place", "id", "day", "amount")
    own_id = F.when(F.col("own"), F.col("id"))
    member = F.when(F.col("own"), F.struct("id", "day", "amount"))
    in_order = f"IGNORE NULLS OVER (PARTITION BY {', '.join(_CELL)}, slice ORDER BY place, id)"
    seen = visits.withColumns({"own_id": own_id, "member": member}).select(
        *visits.columns,
        F.expr(f"lag(own_id) {in_order}").alias("previous_id"),
        F.expr(f"lead(member) {in_order}").alias("next_member"),
    ).where(F.col("place") == 0)
    m = F.col("next_member")
    close = F.abs(F.col("day") - m["day"]) <= grid.days
    similar = amounts_are_similar(F.col("amount"), m["amount"], grid.threshold)
    visitor_matches = close & (~F.col("facet").startswith("a:") | similar)
    return seen.where(
        F.when(F.col("own"), F.col("previous_id").isNotNull()).otherwise(visitor_matches)
    ).select(
        F.when(F.col("own"), F.col("id")).otherwise(m["id"]).alias("round_id"),
        F.when(F.col("own"), F.col("previous_id")).otherwise(F.col("id")).alias("winner_id"),
    )


def _carried(rounds: DataFrame, grid: _Grid, large: DataFrame) -> DataFrame:
    """For slices of cells: the last member of the slices before (``place`` -1) and the first of those behind (1).

    Only slices that can use them get them: members look back, visitors look ahead.
    """
    cell = _CELL
    keys = large.select("company_id")
    cut = _with_id_slice(grid.place(rounds.join(keys, "company_id", "left_semi")), large).select(
        "company_id", "tier", "id", "day", "amount", "slice", F.explode(_visited(grid)).alias("visit"),
    ).select("company_id", "tier", "visit.*", "slice", "id", "day", "amount")
    own_id = F.when(F.col("own"), F.col("id"))
    backward = Window.partitionBy(*cell).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    forward = Window.partitionBy(*cell).orderBy("slice").rowsBetween(1, Window.unboundedFollowing)
    ends = (
        cut.groupBy(*cell, "slice")
        .agg(
            F.max(own_id).alias("last_id"), F.min(own_id).alias("first_id"), F.min_by("day", own_id).alias("first_day"),
            F.min_by("amount", own_id).alias("first_amount"), F.max(~F.col("own")).alias("visited"),
        )
    )
    first = F.when(F.col("first_id").isNotNull(), F.struct(
        F.col("first_id").alias("id"), F.col("first_day").alias("day"), F.col("first_amount").alias("amount")
    ))
    over = ends.withColumn("first", first).select(
        *cell, "slice",
        F.when(F.col("first_id").isNotNull(), F.max("last_id").over(backward)).alias("before"),
        F.when(F.col("visited"), F.first("first", ignorenulls=True).over(forward)).alias("behind"),
    )
    nothing = F.lit(None)
    both = F.array_compact(F.array(
        F.when(F.col("before").isNotNull(), F.struct(
            F.lit(-1).alias("place"), F.col("before").alias("id"), nothing.cast("int").alias("day"), nothing.cast("double").alias("amount"),
        )),
        F.when(F.col("behind").isNotNull(), F.struct(
            F.lit(1).alias("place"), F.col("behind.id").alias("id"), F.col("behind.day").alias("day"), F.col("behind.amount").alias("amount"),
        )),
    ))
    return over.select(*cell, "slice", F.lit(True).alias("own"), F.inline(both))


def _running(
    events: DataFrame, keys: list[str], combine: Callable[[Column], Column], values: dict[str, Column], cut: bool,
    pick: Callable[[list[Column]], Column],
) -> DataFrame:
    """Queries with what ``pick`` takes of the values combined over the data at or below their ``coord``.

    ``inside`` is taken in ``coord`` order within a slice, ``before`` from the earlier slices of the run. Runs that are
    not cut have no number of a slice.
    """
    data = {v: F.when(~F.col("is_query"), c) for v, c in values.items()}
    run = (
        Window.partitionBy(*keys, "slice").orderBy("coord", "is_query")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    queries = (
        events.select("*", *[combine(c).over(run).alias(v) for v, c in data.items()]).where(F.col("is_query"))
        .withColumn("inside", pick([F.col(v) for v in values])).drop(*values)
    )
    if not cut:
        return queries.withColumn("before", F.lit(None).cast(queries.schema["inside"].dataType))
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        events.where(F.col("slice").isNotNull()).groupBy(*keys, "slice")
        .agg(*[combine(c).alias(v) for v, c in data.items()], F.max("is_query").alias("asked"))
        .select(*keys, "slice", "asked", *[combine(F.col(v)).over(earlier).alias(v) for v in values])
        .where(F.col("asked") & F.coalesce(*[F.col(v) for v in values]).isNotNull()).drop("asked")
    )
    return queries.join(totals, [*keys, "slice"], "left").withColumn("before", pick([F.col(v) for v in values])).drop(*values)


_NODE = ["bucket", "node"]


def _border_events(
    points: DataFrame, grid: _Grid, keep: list[str], downward: bool, large: DataFrame | None,
    gives: str = "true", asks: str = "true",
) -> DataFrame:
    """Data and queries for amounts similar across a bucket border.

    Upward, a point asks its higher neighbour buckets for amounts up to its upper limit;
    downward (coordinates negated) its lower ones for amounts down to its lower limit. The points that ``gives`` holds for
    are data, those that ``asks`` holds for ask. Rows are many and hold little: a bucket and its direction are one number.
    """
    low, high = grid.amount_range()
    ready = grid.place(points).withColumns({"low": low, "high": high})
    if large is None:
        ready = ready.withColumn("is_cut", F.lit(False))
    else:
        ready = ready.join(large.select("company_id", F.lit(True).alias("is_cut")), "company_id", "left")
    # Buckets, directions and levels are rows of their own, so that all else is plain arithmetic on them.
    asked = ready.select("*", F.explode(F.sequence("lowest" if downward else "bucket", "highest")).alias("other"))
    if downward:
        signs = F.expr("CASE WHEN other > bucket THEN array(1) WHEN other < bucket THEN array(-1) ELSE array(1, -1) END")
        asked = asked.select("*", F.explode(signs).alias("sign"))
    else:
        asked = asked.withColumn("sign", F.lit(1))
    levels = F.array(*[F.lit(level) for level in range(grid.levels + 1)])
    rows = (
        asked.withColumn("is_query", F.expr("other <> bucket")).where(f"CASE WHEN is_query THEN {asks} ELSE {gives} END")
        .withColumn("at", F.expr("CASE WHEN NOT is_query THEN amount WHEN sign > 0 THEN high ELSE low END"))
        .select("*", F.explode(levels).alias("level"))
    )
    return rows.select(
        *keep,
        F.expr("CAST(2 * other + CASE WHEN sign > 0 THEN 1 ELSE 0 END AS BIGINT) AS bucket"),
        F.expr(f"CASE WHEN is_query THEN {grid.near_node()} ELSE {grid.own_node()} END AS node"),
        "is_query", F.expr("sign * at AS coord"),
        F.expr(
            f"CASE WHEN is_cut AND {grid.cuts('level')} > 1 THEN "
            f"CAST(sign * floor(ln(at) * {grid.cuts('level')} / {grid.width!r}D) AS BIGINT) END AS slice"
        ),
    )


def _across_border(known: DataFrame, grid: _Grid) -> DataFrame:
    """The rounds that may gain by an amount across a bucket border (``asks``), and those whose id one of them may gain (``gives``).

    The latter are told by bucket, day and tier: their id is larger than the least that is known to a round of a worse tier
    that asks there.
    """
    placed = grid.place(known.where("amount > 0")).withColumn("held", F.coalesce("known", F.lit(_LEAST))).withColumn(
        "asks", F.coalesce(F.col("beside") > F.col("held"), F.lit(False))
    )
    places = ["company_id", "bucket", "day"]
    asked = placed.where("asks").select(
        "company_id", F.explode(F.sequence("lowest", "highest")).alias("bucket"), "day", "tier", "held", F.lit(False).alias("here")
    )
    there = placed.select(*places, "tier", F.lit(None).cast("bigint").alias("held"), F.lit(True).alias("here"))
    near = Window.partitionBy("company_id", "bucket").orderBy("day").rangeBetween(-grid.days, grid.days)
    least = (
        asked.unionByName(there).groupBy(*places)
        .agg(F.max("here").alias("here"), *[F.min(F.when(F.col("tier") > t, F.col("held"))).alias(f"least{t}") for t in TIERS])
        .select(*places, "here", F.array(*[F.min(f"least{t}").over(near) for t in TIERS]).alias("least"))
        .where(F.col("here") & F.col("least")[0].isNotNull()).drop("here")
    )
    gives = F.coalesce(F.col("id") > F.get("least", F.col("tier")), F.lit(False))
    return kept(
        placed.join(_lookup(least), places, "left").withColumn("gives", gives).where("asks OR gives")
        .select("company_id", "id", "day", "amount", "tier", "held", "asks", "gives")
    )


def _better_tier_across_border(points: DataFrame, grid: _Grid, large: DataFrame | None) -> DataFrame:
    keep, node = ["company_id", "id", "tier", "held"], ["company_id", *_NODE]
    better = {f"better{t}": F.when(F.col("tier") < t, F.col("id")) for t in range(1, 10)}
    data = _border_events(points.where("gives"), grid, keep, downward=True, large=large, asks="false")
    queries = _border_events(points.where("asks"), grid, keep, downward=True, large=large, gives="false")
    # Nodes are asked only where the largest of their ids is a gain.
    bests = _lookup(data.groupBy(*node).agg(F.array(*[F.max(c) for c in better.values()]).alias("best")))
    asked = queries.join(bests, node).where(_for_own_tier("best") > F.col("held")).select(data.columns)
    found = _running(
        data.unionByName(asked), node, F.max, better, large is not None,
        lambda ids: F.get(F.array(*ids), F.col("tier") - 1),
    )
    return found.select(
        F.col("id").alias("round_id"), F.greatest("inside", "before").alias("winner_id"), "held"
    ).where(F.col("winner_id") > F.col("held")).drop("held")


def winner_candidates(features: DataFrame, options: DedupOptions) -> DataFrame:
    """(round_id, winner_id) rows; the largest winner per round is the right one.

    A constant number of rows per round, all of them true matches with a better round.
    """
    grid = _Grid(options)
    known = _with_known(features, grid)
    same = _of_same_tier(known, grid)
    found = [
        known.select(F.col("id").alias("round_id"), F.col("known").alias("winner_id")),
        _same_tier_previous(same, grid, _large_companies(same, options)),
    ]
    if grid.tolerant:
        points = _across_border(known, grid)
        found.append(_better_tier_across_border(points, grid, _large_companies(points, options)))
    return reduce(DataFrame.unionByName, found).where(F.col("winner_id").isNotNull())


# ---------------------------------------------------------------- pair counts


def _name_classes() -> Column:
    """array<struct<name, sign>> such that, summed with their signs, the classes two rounds
    share count 1 if their names match and 0 if not.

    For keywords these are all non-empty sets of a round's keywords (inclusion-exclusion).
    """
    mask = F.col("mask")
    subsets = F.when(mask == 0, F.array().cast("array<int>")).otherwise(
        F.filter(F.sequence(F.lit(1), mask), lambda s: s.bitwiseAND(mask) == s)
    )
    keywords = F.transform(
        subsets,
        lambda s: F.struct(
            F.concat(F.lit("k"), s.cast("string")).alias("name"),
            (F.bit_count(s) % 2 * 2 - 1).cast("int").alias("sign"),
        ),
    )
    whole = F.struct(
        F.concat(F.lit("n:"), F.col("name_key")).alias("name"), F.lit(1).alias("sign")
    )
    return F.when(F.col("name_key").isNotNull(), F.array(whole)).otherwise(keywords)


def _pairs_below(events: DataFrame, keys: list[str], cut: bool) -> DataFrame:
    """Per slice of a run, ``pairs`` of its queries with the data at or below their ``coord``, each weighted by ``n``.

    Only sums are asked for, so one sorted pass gives what a slice holds and asks for, and earlier slices are carried over
    between these sums. Rows are sorted by a number of their slice first: it tells most of them apart without reading
    the keys, of which the first are the same for most rows.
    """
    slices = ["number", *keys, "slice"]
    run = Window.partitionBy(*slices).orderBy("coord", "is_query").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asked = F.when(F.col("is_query"), F.col("n"))
    sums = (
        events.withColumn("number", F.xxhash64(*keys, "slice"))
        .withColumn("below", F.sum(F.when(~F.col("is_query"), F.col("n"))).over(run))
        .groupBy(*slices).agg(
            F.sum(asked * F.col("below")).alias("inside"), F.sum(asked).alias("asked"), F.max("below").alias("held"),
        )
    )
    if cut:
        earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        before = F.when(F.col("slice").isNotNull(), F.sum("held").over(earlier))
        sums = sums.withColumn("before", F.col("asked") * before)
    else:
        sums = sums.withColumn("before", F.lit(0))
    return sums.select(*keys, (F.coalesce("inside", F.lit(0)) + F.coalesce("before", F.lit(0))).alias("pairs")).where(F.col("pairs") > 0)


def pair_counts(features: DataFrame, options: DedupOptions) -> DataFrame:
    """(company_id, pairs): pairs matching by name, plus by amount, minus by both."""
    grid = _Grid(options)
    points = grid.place(
        features.groupBy("company_id", "day", "amount", "mask", "name_key").agg(F.count("*").alias("n"))
    ).withColumn("classes", _name_classes())
    negative = F.coalesce(F.col("amount") < 0, F.lit(False))
    clique = F.when(F.col("positive"), grid.amount_facet()).when(negative, F.lit("m"))
    nothing = F.lit("")

    def signed(name: Column, facet: Column, sign: Column) -> Column:
        return F.struct(name.alias("name"), facet.alias("facet"), sign.alias("sign_of"))

    # Shared class or bucket: counts per calendar day, then a date-range window.
    by_name = F.transform("classes", lambda c: signed(c["name"], nothing, c["sign"]))
    by_clique = F.concat(
        F.array(signed(nothing, clique, F.lit(1))),
        F.transform("classes", lambda c: signed(c["name"], clique, -c["sign"])),
    )
    terms = F.when(clique.isNotNull(), F.concat(by_name, by_clique)).otherwise(by_name)
    group = ["company_id", "name", "facet", "sign_of"]
    near = Window.partitionBy(*group).orderBy("day").rangeBetween(-grid.days, grid.days)
    flat = (
        points.select("company_id", "day", "n", F.explode(terms).alias("t"))
        .select("company_id", "day", "n", "t.*")
        .groupBy(*group, "day").agg(F.sum("n").alias("n"))
        .select("*", F.sum("n").over(near).alias("close"))
        .select("company_id", (  # every pair is seen from both of its rounds
            F.col("sign_of").cast(_BIG) * (F.col("n").cast(_BIG) * (F.col("close") - 1).cast(_BIG))
        ).alias("twice"))
    )
    parts = [flat]
    if grid.tolerant:
        large = _large_companies(features, options)
        # Similar amounts of neighbouring buckets, each pair seen from its smaller amount.
        scopes = F.concat(
            F.array(F.struct(nothing.alias("name"), F.lit(1).alias("sign_of"))),
            F.transform("classes", lambda c: F.struct(c["name"].alias("name"), (-c["sign"]).alias("sign_of"))),
        )
        scoped = (
            points.where("positive")
            .select("company_id", "day", "amount", "n", F.explode(scopes).alias("s"))
            .select("company_id", "day", "amount", "n", "s.*")
            .groupBy("company_id", "name", "sign_of", "day", "amount").agg(F.sum("n").alias("n"))
        )
        events = _border_events(
            scoped, grid, ["company_id", "name", "sign_of", "n"], downward=False, large=large
        )
        counted = _pairs_below(events, ["company_id", "name", "sign_of", *_NODE], large is not None)
        parts.append(counted.select("company_id", (
            F.col("sign_of").cast(_BIG) * F.col("pairs").cast(_BIG) * 2
        ).cast(_BIG).alias("twice")))
    total = reduce(DataFrame.unionByName, parts).groupBy("company_id").agg(
        (F.sum("twice") / 2).cast("bigint").alias("pairs")
    )
    return total.where(F.col("pairs") > 0)
