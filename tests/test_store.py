"""The versioned store: what readers see when a writer breaks, two writers meet, rows change and folders go."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from capledger.plans import stored
from capledger.sources import store as store_module
from capledger.sources.store import Conflict, Layout, Store
from capledger.streaming import rounds as round_stream

LAYOUT = {"t": Layout("id BIGINT, owner BIGINT, value STRING", ("id",), "owner", 4), "pair": Layout("a INT, b STRING, c DOUBLE", ("a", "b"))}
T0 = dt.datetime(2024, 1, 1)


def rows(spark, *values):
    return spark.createDataFrame([(i, i % 5, v) for i, v in values], "id BIGINT, owner BIGINT, value STRING").coalesce(1)


def held(df):
    return sorted((r.id, r.value) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), LAYOUT)


def test_nothing_is_read_from_an_empty_store(store):
    assert store.read("t").columns == ["id", "owner", "value"] and store.read("t").count() == 0
    assert store.read("pair").count() == 0 and store.manifest().version == 0


def test_a_writer_that_breaks_leaves_nothing_visible(spark, store, monkeypatch):
    with store.transaction() as tx:
        tx.append("t", rows(spark, (1, "a")))
    with pytest.raises(ZeroDivisionError), store.transaction() as tx:
        tx.append("t", rows(spark, (2, "b")))
        raise ZeroDivisionError  # between the tables of one commit
    monkeypatch.setattr(store, "publish", lambda manifest: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError), store.transaction() as tx:
        tx.append("t", rows(spark, (3, "c")))
        tx.append("pair", spark.createDataFrame([(1, "x", 2.0)], "a INT, b STRING, c DOUBLE"))
    monkeypatch.undo()  # it broke after all folders were written, before the switch
    other = Store(spark, store.root, LAYOUT)
    assert held(other.read("t")) == [(1, "a")] and other.read("pair").count() == 0
    with other.transaction() as tx:
        tx.append("t", rows(spark, (4, "d")))
    assert held(store.read("t")) == [(1, "a"), (4, "d")]
    assert len(store.vacuum()) == 3 and held(store.read("t")) == [(1, "a"), (4, "d")]
    assert not [f for f in os.listdir(f"{store.root}/_manifests") if "draft" in f]


def test_of_two_writers_one_starts_again(spark, store):
    with pytest.raises(Conflict), store.transaction() as slow:
        slow.append("t", rows(spark, (1, "slow")))
        with store.transaction() as quick:
            quick.append("t", rows(spark, (1, "quick")))
    assert held(store.read("t")) == [(1, "quick")]


def test_changes_hide_rows_until_they_are_added_again(spark, store):
    def commit(write):
        with store.transaction() as tx:
            write(tx)
        return held(store.read("t"))

    assert commit(lambda tx: tx.append("t", rows(spark, *[(i, "a") for i in range(6)]))) == [(i, "a") for i in range(6)]
    assert commit(lambda tx: tx.change("t", rows(spark, (1, "b"), (9, "new"))))[1:] == [(1, "b"), *[(i, "a") for i in range(2, 6)], (9, "new")]
    commit(lambda tx: tx.change("t", rows(spark, (1, None))))
    gone = rows(spark, (2, ""), (3, "")).select("id", "owner")
    now = commit(lambda tx: tx.remove("t", gone))
    assert now == [(0, "a"), (1, None), (4, "a"), (5, "a"), (9, "new")]
    assert commit(lambda tx: tx.append("t", rows(spark, (2, "again")))) == sorted([*now, (2, "again")], key=lambda r: r[0])
    before = held(store.read("t"))
    assert sorted(held(store.read("t", buckets=[0, 1])) + held(store.read("t", buckets=[2, 3]))) == sorted(before, key=lambda r: r[0])
    store.compact("t")
    assert held(store.read("t")) == before and not store.manifest().changes["t"]
    assert held(store.read("t", version=1)) == [(i, "a") for i in range(6)]
    store.vacuum(keep=1)
    assert held(store.read("t")) == before and len(os.listdir(f"{store.root}/t")) == 1
    with pytest.raises(KeyError):
        store.read("t", version=1)


def test_keys_of_several_columns_and_a_read_inside_a_commit(spark, store):
    pairs = lambda *r: spark.createDataFrame(list(r), "a INT, b STRING, c DOUBLE")
    with store.transaction() as tx:
        tx.append("pair", pairs((1, "x", 1.0), (1, "y", 1.0)))
        tx.change("pair", pairs((1, "x", 2.0)))
        assert {tuple(r) for r in tx.read("pair").collect()} == {(1, "x", 2.0), (1, "y", 1.0)}
        assert store.read("pair").count() == 0
    assert {tuple(r) for r in store.read("pair").collect()} == {(1, "x", 2.0), (1, "y", 1.0)}


def test_the_last_write_of_a_commit_counts(spark, store):
    with store.transaction() as tx:
        tx.append("t", rows(spark, *[(i, "a") for i in range(400)]))
    key = lambda *ids: rows(spark, *[(i, "") for i in ids]).select("id", "owner")
    with store.transaction() as tx:
        tx.change("t", rows(spark, *[(i, "b") for i in range(0, 400, 2)]).repartition(4))
        tx.remove("t", key(*range(0, 400, 4)))  # changed and removed in one commit
        tx.remove("t", key(1, 3))
        tx.change("t", rows(spark, (3, "c")))  # and the other way round
        tx.append("t", rows(spark, (1, "again")))  # a key that this commit has removed
    want = sorted([(i, "b" if i % 2 == 0 else "a") for i in range(400) if i % 4 and i not in (1, 3)] + [(1, "again"), (3, "c")])
    assert held(store.read("t")) == want
    store.compact("t")
    assert held(store.read("t")) == want


def test_numbered_commits_are_made_once(spark, store):
    for number in (0, 1, 1, 0):
        with store.transaction("feed", number) as tx:
            if not tx.repeated:
                tx.append("t", rows(spark, (number, "x")))
    assert held(store.read("t")) == [(0, "x"), (1, "x")] and store.manifest().version == 2


def scanned(df):
    """The partition filters of the scans in the plan."""
    return [line for line in df._jdf.queryExecution().toString().split("\n") if "PartitionFilters" in line]


def test_reading_some_buckets_prunes_the_files_of_all_others(spark, store):
    with store.transaction() as tx:
        tx.append("t", rows(spark, *[(i, "a") for i in range(40)]))
        tx.change("t", rows(spark, (3, "b")))
    [bucket] = store.buckets_of("t", rows(spark, (3, "")))
    part = store.read("t", buckets=[bucket])
    assert (3, "b") in held(part) and part.count() < 40
    files = {f.split("_bucket=")[1].split("/")[0] for f in part.inputFiles()}
    every = {f.split("_bucket=")[1].split("/")[0] for f in store.read("t").inputFiles()}
    assert len(every) > 1 and all("_bucket" in line for line in scanned(part))
    assert files  # listed before pruning; the scans above carry the filter on the partition column


def test_what_a_transaction_keeps_is_gone_at_its_end(spark, store):
    drafts = f"{store.root}/_drafts"
    with store.transaction() as tx:
        kept = tx.keep(rows(spark, (1, "a"), (2, "b")))
        tx.append("t", kept.where("id = 1"))
        assert held(kept) == [(1, "a"), (2, "b")] and len(os.listdir(drafts)) == 1
    assert held(store.read("t")) == [(1, "a")] and not os.listdir(drafts)
    with pytest.raises(ZeroDivisionError), store.transaction() as tx:
        tx.keep(rows(spark, (3, "c")))
        raise ZeroDivisionError
    assert not os.listdir(drafts)


def test_a_collection_makes_no_checkpoints_and_keeps_no_drafts(spark, tmp_path, monkeypatch):
    """What several writes of a stage read lies in Parquet, of which each reads its columns only."""
    store = Store(spark, str(tmp_path / "all"))
    now = F.lit(T0)
    answers = [(1, 'x [{"round_name": "Seed", "all_investors": ["A", "B"], "source_url": "u"}, {"round_name": "Seed"}]'), (2, "[]")]

    def refused(*_, **__):
        raise AssertionError("checkpoint")

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", refused)
    stored.register_companies(store, spark.createDataFrame([("X",), ("Y",)], "name STRING"), now)
    ids = {r.name: r.id for r in store.read("companies").collect()}
    responses = spark.createDataFrame([(ids["XY"[i - 1]], a) for i, a in answers], "company_id BIGINT, response STRING")
    hits = spark.createDataFrame([], "company_id BIGINT, query_no INT, rank INT, title STRING, url STRING, snippet STRING")
    stored.collect_search(store, hits, responses, "round_robin", now)
    assert [store.read(t).count() for t in ("funding_rounds", "sources", "investors", "round_investors")] == [2, 1, 2, 2]
    assert {r.stage3_rounds_found for r in store.read("processing_status").collect()} == {0, 2}
    assert not os.listdir(f"{store.root}/_drafts")


def test_a_merge_writes_the_rows_it_touches_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    columns = store_module.LAYOUTS["funding_rounds"].schema
    day = ["2020-01-01", "2020-01-05", "2015-01-01", None]
    data = [
        (i, c, "Seed", day[i % 4], 1.0, None, None, None, "WEB_SEARCH", "LOW", None, None, None, False, None, T0, T0)
        for c in (1, 2) for i in range(c * 100, c * 100 + 4)
    ]
    with store.transaction() as tx:
        tx.append("funding_rounds", spark.createDataFrame(data, columns))
    stored.merge_rounds(store, F.lit(T0))
    rounds = {r.id: (r.is_duplicate, r.duplicate_of_id) for r in store.read("funding_rounds").collect()}
    assert {i for i, (lost, _) in rounds.items() if lost} == {101, 201} and rounds[101] == (True, 100) and len(rounds) == 8
    [(folder, _)] = store.manifest().changes["funding_rounds"]
    assert spark.read.parquet(f"{store.root}/funding_rounds/{folder}").count() == 2
    assert {r.company_id: (r.stage4_merged, r.stage4_unique_rounds) for r in store.read("processing_status").collect()} == {1: (True, 3), 2: (True, 3)}
    version = store.manifest().version
    stored.merge_rounds(store, F.lit(T0))  # all companies are merged
    assert sum(spark.read.schema("id BIGINT").parquet(f"{store.root}/funding_rounds/{f}").count() for f, _ in store.manifest().changes["funding_rounds"]) == 2
    assert store.manifest().version == version + 1


def test_merge_stream_reads_touched_buckets_and_survives_a_repeated_batch(spark, tmp_path):
    columns = store_module.LAYOUTS["funding_rounds"].schema
    landed = tmp_path / "landed"

    def land(number, *ids):
        data = [
            (i, i % 3, "Seed", f"2020-01-{1 + i % 28:02d}", 1.0, None, None, None, "WEB_SEARCH", "LOW", None, None, None, False, None, T0, T0)
            for i in ids
        ]
        spark.createDataFrame(data, columns).coalesce(1).write.parquet(f"{landed}/{number}")

    def drain(**options):
        stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(f"{landed}/*")
        round_stream.merge_stream(stream, f"{tmp_path}/store", f"{tmp_path}/checkpoint", buckets=4, compact_every=3, **options).awaitTermination()

    land(0, 1, 2, 3)
    land(1, 4, 6)
    drain()
    store = round_stream.merge_store(spark, f"{tmp_path}/store", 4)
    before = store.manifest()
    # the next commit's mark in the checkpoint is lost, so the last batch is delivered again
    last = max(int(f) for f in os.listdir(f"{tmp_path}/checkpoint/commits") if f.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{tmp_path}/checkpoint/commits/{name}"):
            os.remove(f"{tmp_path}/checkpoint/commits/{name}")
    drain()
    assert store.manifest() == before
    land(2, 7, 9, 5)
    drain()
    from capledger.operators import dedup

    rounds = store.read("rounds")
    assert rounds.count() == 8
    want = {r.round_id: r.winner_id for r in dedup.losers(rounds).collect()}
    assert {r.id: r.winner_id for r in store.read("marks").collect()} == {i: want.get(i) for i in (1, 2, 3, 4, 5, 6, 7, 9)}


def test_large_tables_are_not_broadcast_however_small_their_files(spark, store, monkeypatch):
    from capledger.operators.dedup import pending_rounds
    from capledger.operators.entities import new_names

    def plan(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    with store.transaction() as tx:
        tx.append("t", spark.range(3000).selectExpr("id", "id % 5 AS owner", "'a' AS value"))
    with store.transaction() as tx:
        tx.change("t", spark.range(2000).selectExpr("id", "id % 5 AS owner", "'b' AS value"))
    with store.transaction() as tx:
        tx.append("t", spark.range(3000, 4500).selectExpr("id", "id % 5 AS owner", "'c' AS value"))
    assert "BroadcastHashJoin" in plan(store.read("t"))  # of few rows they may be
    monkeypatch.setattr("capledger.session.BROADCAST_ROWS", 1000)
    assert "BroadcastHashJoin" not in plan(store.read("t"))
    assert {r.value: r["count"] for r in store.read("t").groupBy("value").count().collect()} == {"a": 1000, "b": 2000, "c": 1500}
    assert store.count("t", store.manifest().changes["t"]) == 2000 and store.count_at_most("t") == 6500

    path = f"{store.root}-names"
    spark.range(2000).selectExpr("concat('n', id) AS name", "id AS company_id", "id % 2 = 0 AS stage4_merged").write.parquet(path)
    known = spark.read.parquet(path)
    fresh = new_names(known, spark.createDataFrame([("n1",), ("new",)], "name STRING"))
    assert "BroadcastHashJoin" not in plan(fresh) and [r.name for r in fresh.collect()] == ["new"]
    monkeypatch.setattr("capledger.session.BROADCAST_ROWS", 900)
    left = pending_rounds(spark.createDataFrame([(1,), (2,), (5000,)], "company_id BIGINT"), known)
    assert "BroadcastHashJoin" not in plan(left) and sorted(r.company_id for r in left.collect()) == [1, 5000]
