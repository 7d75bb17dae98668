"""New rounds arriving as a stream: repeated arrivals, and de-duplication of what they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from capledger.operators import dedup
from capledger.options import DedupOptions
from capledger.schema import TABLES
from capledger.sources.store import Layout, Store

#: What a round says, apart from its id and the time it was collected.
CONTENT = (
    "company_id", "source_type", "round_name", "date", "amount_raised_usd", "pre_money_valuation_usd",
    "post_money_valuation_usd", "lead_investor", "source_urls",
)


def first_arrivals(rounds: DataFrame, key: tuple[str, ...] = ("id",)) -> DataFrame:
    """Drop rounds whose key has been seen before, however late they come.

    By id, a row delivered again is dropped; by ``CONTENT``, also a round that a later run has collected again under
    another id. The state holds every key; nothing is given up to keep it small.
    """
    return rounds.dropDuplicates(list(key))


def merge_store(spark: SparkSession, root: str, buckets: int = 64) -> Store:
    """The store that ``merge_stream`` keeps: rounds as they arrived, and a mark for each."""
    marks = "id BIGINT, company_id BIGINT, winner_id BIGINT"
    return Store(spark, root, {
        "rounds": Layout(TABLES["funding_rounds"], ("id",), "company_id", buckets),
        "marks": Layout(marks, ("id",), "company_id", buckets),
    })


def merge_stream(
    arrivals: DataFrame, root: str, checkpoint: str, options: DedupOptions = dedup.DEFAULTS, buckets: int = 64,
    compact_every: int = 32,
) -> StreamingQuery:
    """Store arriving rounds and keep the marks of all rounds up to date.

    Marks are what one run over all stored rounds gives. A batch reads the buckets of the companies it touches and no
    other files, writes its rounds and the marks that are new or differ, and commits both as one version. A batch that is
    delivered again after it was committed is passed over. Every so many versions each table is folded into one folder.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        store = merge_store(batch.sparkSession, root, buckets)
        with store.transaction("batches", batch_id) as tx:
            if tx.repeated:
                return
            tx.append("rounds", batch)
            new = tx.added("rounds")
            touched = store.buckets_of("rounds", new)
            affected = tx.read("rounds", touched).join(new.select("company_id").distinct(), "company_id", "left_semi").select(new.columns)
            winners = dedup.losers(affected, options).withColumnRenamed("round_id", "id")
            marks = affected.select("id", "company_id").join(winners, "id", "left")
            before = tx.read("marks", touched).selectExpr("id", "winner_id AS old_id", "true AS known")
            compared = marks.join(before, "id", "left")
            tx.append("marks", compared.where("known IS NULL"))
            tx.change("marks", compared.where("known AND NOT winner_id <=> old_id"))
        if store.manifest().version % compact_every == 0:
            for name in ("rounds", "marks"):
                store.compact(name)

    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )
