"""The two plans against a plain pair loop, on random rounds full of ties and borders."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from capledger.operators import dedup
from capledger.options import DedupOptions
from capledger.schema import FUNDING_ROUNDS

NAMES = [
    None, "", " ", "Seed", "Pre-Seed", " series a ", "Series A Seed", "Series Alpha", "Series B",
    "Series B seed series c", "Form D Filing", "form d filing", "Bridge",
]
KEYWORDS = ["seed"] + [f"series {c}" for c in "abcdefgh"]


def random_rounds(seed, n, companies, days):
    rng = random.Random(seed)
    start = dt.date(2019, 12, 1)
    rows = []
    for _ in range(n):
        day = start + dt.timedelta(days=rng.randrange(days))
        date = rng.choice([day.isoformat()] * 6 + [day.strftime("%m/%d/%Y"), day.strftime("%Y-%m"), None, "soon"])
        amount = rng.choice([
            None, 0.0, 90.0, 100.0, 110.0, 111.11, 99.99999999999999, -5.0, -70.0, float("nan"),
            round(rng.uniform(50, 200), 2), round(rng.uniform(50, 200), 2), 10 ** rng.uniform(0, 7),
        ])
        rows.append((
            rng.randrange(companies), rng.choice(NAMES), date, amount,
            rng.choice([None, 0.0, 400.0]), rng.choice([None, 500.0]), rng.choice([None, "", "Lead"]),
            rng.choice(["HIGH", "MEDIUM", "LOW"]), rng.random() < 0.1,
        ))
    ids = rng.sample(range(10 * n), n)
    return [
        (i, c, name, date, a, pre, post, lead, "WEB_SEARCH", conf, None, None, None, dup, None, None, None)
        for i, (c, name, date, a, pre, post, lead, conf, dup) in zip(ids, rows)
    ]


def parse(text):
    for pattern in ("%Y-%m-%d", "%Y-%m", "%Y", "%m/%d/%Y", "%d/%m/%Y"):
        try:
            return dt.datetime.strptime(text or "", pattern)
        except ValueError:
            pass
    return None


def matches(a, b, days, threshold):
    da, db = parse(a[3]), parse(b[3])
    if not da or not db or abs((da - db).days) > days:
        return False
    if a[4] and b[4] and a[4] == a[4] and b[4] == b[4] and abs(max(a[4], b[4]) - min(a[4], b[4])) / max(a[4], b[4]) <= threshold:
        return True
    if not a[2] or not b[2]:
        return False
    na, nb = a[2].lower().strip(), b[2].lower().strip()
    return na == nb or any(k in na and k in nb for k in KEYWORDS)


def brute_force(rows, days=90, threshold=0.10):
    open_rows = sorted(r for r in rows if not r[13])
    pairs, winner = {}, {}
    for x, a in enumerate(open_rows):
        for b in open_rows[x + 1:]:
            if a[1] == b[1] and matches(a, b, days, threshold):
                score = lambda r: (r[9] == "HIGH", sum(map(bool, (r[4], r[5], r[6], r[7]))))
                w, l = (a, b) if score(a) >= score(b) else (b, a)
                pairs.setdefault(a[1], []).append((l[0], w[0]))
                winner[l[0]] = max(w[0], winner.get(l[0], -1))
    return pairs, winner


@pytest.mark.parametrize("seed,n,companies,days,limit,proximity,threshold", [
    (1, 400, 40, 500, 1000, 90, 0.10),
    (2, 300, 2, 600, 0, 90, 0.10),
    (3, 250, 1, 60, 0, 20, 0.25),
    (4, 300, 3, 900, 0, 0, 0.10),
    (5, 300, 4, 400, 80, 90, 0.0),
    (6, 300, 2, 400, 0, 90, 0.10),
])
@pytest.mark.parametrize("slice_rows", [100_000, 25])
def test_both_plans_equal_the_pair_loop(spark, seed, n, companies, days, limit, proximity, threshold, slice_rows):
    rows = random_rounds(seed, n, companies, days)
    rounds = spark.createDataFrame(rows, FUNDING_ROUNDS)
    options = DedupOptions(proximity, threshold, True, limit, slice_rows)
    pairs, winner = brute_force(rows, proximity, threshold)

    assert {r.round_id: r.winner_id for r in dedup.losers(rounds, options).collect()} == winner
    counted = {r.company_id: r.pairs for r in dedup.pair_counts(rounds, options).collect()}
    assert counted == {c: len(p) for c, p in pairs.items()}
    listed = sorted((r.loser_id, r.winner_id) for r in dedup.matching_pairs(rounds, options).collect())
    assert listed == sorted(p for ps in pairs.values() for p in ps)


def test_slices_follow_the_size_of_their_company(spark):
    from capledger.operators import dense

    ids = [(1, i) for i in range(4000)] + [(2, 10_000 + i * i) for i in range(900)] + [(3, i) for i in range(50)]
    features = spark.createDataFrame(ids, "company_id BIGINT, id BIGINT")
    large = dense._large_companies(features, DedupOptions(slice_rows=100))
    sizes = {}
    for r in dense._with_id_slice(features, large).groupBy("company_id", "slice").count().collect():
        sizes.setdefault(r.company_id, []).append(r["count"])
    assert len(sizes[1]) == 40 and len(sizes[2]) == 9 and sizes[3] == [50]
    assert max(sizes[1] + sizes[2]) <= 150  # no task holds much more than a slice
    assert dense._large_companies(features, DedupOptions()) is None


@pytest.mark.parametrize("seed,n,companies,days,proximity,threshold,slice_rows,window_rows", [
    (7, 300, 2, 600, 90, 0.10, 25, 0), (8, 250, 1, 900, 20, 0.25, 25, 12), (9, 300, 3, 900, 0, 0.10, 100_000, 0),
    (10, 300, 4, 400, 90, 0.0, 25, 20), (11, 300, 1, 3000, 90, 0.10, 100_000, 30),
])
def test_windows_of_few_and_of_many_rounds_lose_and_repeat_no_pair(spark, seed, n, companies, days, proximity, threshold, slice_rows, window_rows):
    rows = random_rounds(seed, n, companies, days)
    rounds = spark.createDataFrame(rows, FUNDING_ROUNDS)
    options = DedupOptions(proximity, threshold, True, 0, slice_rows, window_rows)
    pairs, winner = brute_force(rows, proximity, threshold)
    assert {r.round_id: r.winner_id for r in dedup.losers(rounds, options).collect()} == winner
    assert {r.company_id: r.pairs for r in dedup.pair_counts(rounds, options).collect()} == {c: len(p) for c, p in pairs.items()}
    stats = dedup.run_statistics(rounds, options).first()
    assert (stats.duplicates_removed, stats.distinct_duplicates) == (sum(map(len, pairs.values())), len(winner))


def test_rounds_of_few_neighbours_leave_nothing_to_the_sorted_runs(spark):
    rows = [r for r in random_rounds(12, 400, 40, 2000)]
    options = DedupOptions(dense_company_rows=0, slice_rows=8)
    _, rest = dedup._pairs_and_rest(spark.createDataFrame(rows, FUNDING_ROUNDS), options)
    assert rest is None  # they are not exploded over facets, nodes and slices


def test_pairs_across_bucket_borders_are_counted_without_a_lambda(spark):
    """Event rows are as many as a point's nodes; interpreted functions over arrays of them took most of the time."""
    from capledger.operators import dense

    grid = dense._Grid(DedupOptions())
    points = spark.range(200).selectExpr("1L AS company_id", "CAST(id * 7 AS INT) AS day", "1000D + id * id AS amount", "1 AS n")
    events = dense._border_events(points, grid, ["company_id", "n"], downward=False, large=None)
    assert "lambdafunction" not in events._jdf.queryExecution().optimizedPlan().toString()
    asked = {r.is_query: r["count"] for r in events.groupBy("is_query").count().collect()}
    assert asked[False] == (grid.levels + 1) * 200 and asked[True] >= asked[False]


def test_pairs_below_equal_a_join_of_queries_and_data(spark):
    from capledger.operators import dense

    events = spark.range(600).selectExpr(
        "id % 3 AS run", "id % 2 = 0 AS is_query", "CAST((id * 37) % 101 AS DOUBLE) AS coord", "id % 4 + 1 AS n",
    ).withColumn("slice", F.expr("CASE WHEN run < 2 THEN CAST(floor(coord / 20) AS BIGINT) END"))
    want = events.alias("q").join(events.alias("d"), F.expr(
        "q.run = d.run AND q.is_query AND NOT d.is_query AND d.coord <= q.coord"
    )).groupBy("q.run").agg(F.sum(F.expr("q.n * d.n")).alias("pairs"))
    got = dense._pairs_below(events, ["run"], True).groupBy("run").agg(F.sum("pairs").alias("pairs"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    whole = dense._pairs_below(events.withColumn("slice", F.lit(None).cast("bigint")), ["run"], False)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("order", ["random", "day"])
def test_only_rounds_that_can_gain_are_expanded(spark, order):
    """Runs hold several rows per round; of a large company most winners follow from aggregates, whatever the ids follow."""
    from capledger.operators import dense

    rng = random.Random(5)
    made = []
    for _ in range(3000):
        day = (dt.date(2019, 1, 1) + dt.timedelta(days=rng.randrange(1000))).isoformat()
        made.append((rng.choice(["Seed", "Series A", "Series B", "Form D"]), day, round(10 ** rng.uniform(4, 6), 2), rng.choice([None, 5.0]), rng.choice(["HIGH", "LOW"])))
    if order == "day":
        made.sort(key=lambda r: r[1])
    rows = [(i, 1, name, day, a, pre, None, None, "WEB_SEARCH", conf, None, None, None, False, None, None, None) for i, (name, day, a, pre, conf) in enumerate(made)]
    rounds = spark.createDataFrame(rows, FUNDING_ROUNDS)
    options = DedupOptions(dense_company_rows=0, slice_rows=400)
    want = {r.round_id: r.winner_id for r in dedup.losers(rounds, DedupOptions(dense_company_rows=len(rows))).collect()}
    features = dedup.match_features(rounds, options)
    assert {r.round_id: r.winner_id for r in dedup.losers(rounds, options).collect()} == want

    grid = dense._Grid(options)
    known = dense._with_known(features, grid)
    same, points = dense._of_same_tier(known, grid), dense._across_border(known, grid)
    asks, gives = points.where("asks").count(), points.where("gives").count()
    assert same.count() < 0.4 * len(rows) and asks < 0.15 * len(rows) and gives < 0.15 * len(rows), (same.count(), asks, gives)
    # Before a slice is brought together no round is exploded over the cells it visits.
    plan = dense._same_tier_previous(same, grid, dense._large_companies(same, options))._jdf.queryExecution().executedPlan().toString()
    visits = plan[:plan.index("REPARTITION_BY_NUM")]
    assert "Generate explode" in visits and "Exchange hashpartitioning" not in visits.replace("Exchange hashpartitioning(company_id", "", 1)
