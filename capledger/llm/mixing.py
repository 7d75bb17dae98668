"""Mixing sources to target weights by hierarchical budgets.

A token budget goes down a tree of domains, languages and sources. At each node it is divided by the
children's weights; a child that holds less than its share is filled up and what it lacks goes to its
siblings by their weights. Only what all children together cannot take goes to the node's own siblings.
Each leaf then gives full epochs and the longest prefix of one more epoch that fits into its budget; an
epoch is an order of the leaf's documents by a seeded hash.

Prefixes are found without sorting a leaf: token sums over 256 ranges of the hash tell in which range the
prefix ends, the same once more inside it, and only what is left there is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table


@dataclass(frozen=True)
class Settings:
    #: Domain of each source; sources not named here belong to ``other_domain``.
    domains: Mapping[str, str] = field(default_factory=dict)
    other_domain: str = "other"
    #: Weights of the children of a node; a weight of 0 leaves a child out. A name that is not listed has the weight below.
    domain_weights: Mapping[str, float] = field(default_factory=dict)
    language_weights: Mapping[str, float] = field(default_factory=dict)
    source_weights: Mapping[str, float] = field(default_factory=dict)
    other_domain_weight: float = 1.0
    other_language_weight: float = 1.0
    other_source_weight: float = 1.0
    #: The budget: a number of tokens, or else a share of what there is.
    tokens: int | None = None
    share: float = 1.0
    max_epochs: int = 1
    seed: int = 0
    #: Leaves are broadcast up to this number; beyond it they are joined by shuffling.
    broadcast_leaves: int = 50_000


LEAF = ["domain", "lang", "source"]
NONE = "(none)"


def _lookup(column: Column, values: Mapping, otherwise) -> Column:
    if not values:
        return F.lit(otherwise)
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, column), F.lit(otherwise))


def tokens_of(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _fill(children: DataFrame, parent: list[str]) -> DataFrame:
    """``share`` of each child (weight, capacity, budget of its parent): filled up, or by weight from what is left."""
    order = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.col("weight")), *[c for c in LEAF if c in children.columns])
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weights = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = F.col("capacity") * F.col("from_here") <= F.col("weight") * (F.col("budget") - F.col("before"))
    marked = children.withColumn("before", before).withColumn("from_here", weights).withColumn("full", full)
    everyone = Window.partitionBy(*parent)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(everyone), F.lit(0.0))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everyone)
    share = F.when(F.col("full"), F.col("capacity")).otherwise(
        F.least(F.col("capacity"), F.greatest(F.lit(0.0), F.col("left")) * F.col("weight") / F.col("rest"))
    )
    marked = marked.withColumn("left", left).withColumn("rest", rest)
    return marked.withColumn("share", share).drop("before", "from_here", "full", "left", "rest", "budget")


def budgets(leaves: DataFrame, settings: Settings) -> DataFrame:
    """domain, lang, source, available, budget of each leaf of (domain, lang, source, available); weights of 0 are left out."""
    weighted = leaves.withColumn("w1", _lookup(F.col("domain"), settings.domain_weights, settings.other_domain_weight).cast("double")).withColumn(
        "w2", _lookup(F.col("lang"), settings.language_weights, settings.other_language_weight).cast("double")
    ).withColumn("w3", _lookup(F.col("source"), settings.source_weights, settings.other_source_weight).cast("double")).where("w1 > 0 AND w2 > 0 AND w3 > 0")
    leaf = weighted.withColumn("capacity", (F.col("available") * settings.max_epochs).cast("double"))
    lang = leaf.groupBy("domain", "lang", "w1", "w2").agg(F.sum("capacity").alias("capacity"))
    domain = lang.groupBy("domain", "w1").agg(F.sum("capacity").alias("capacity")).withColumn("root", F.lit(0))
    everything = leaves.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("all"))
    wanted = everything.select(
        (F.lit(float(settings.tokens)) if settings.tokens is not None else F.col("all") * settings.share).alias("budget")
    )
    whole = F.sum("capacity").over(Window.partitionBy("root"))
    top = domain.withColumn("budget", F.least(wanted.scalar(), whole)).withColumnRenamed("w1", "weight")
    top = _fill(top, ["root"]).select("domain", F.col("share").alias("budget"))
    middle = _fill(lang.join(top, "domain").withColumnRenamed("w2", "weight"), ["domain"]).select(
        "domain", "lang", F.col("share").alias("budget")
    )
    bottom = _fill(leaf.join(middle, ["domain", "lang"]).withColumnRenamed("w3", "weight"), ["domain", "lang"])
    return bottom.select(*LEAF, "available", F.floor(F.col("share") + 1e-6).cast("long").alias("budget"))


def _with_leaf(docs: DataFrame, settings: Settings, id_at: str, lang_at: str, source_at: str) -> DataFrame:
    source = F.coalesce(F.col(source_at).cast("string"), F.lit(NONE))
    return docs.withColumn("lang", F.coalesce(F.col(lang_at).cast("string"), F.lit(NONE))).withColumn("source", source).withColumn(
        "domain", _lookup(source, settings.domains, settings.other_domain)
    ).withColumn("doc_id", F.coalesce(F.col(id_at).cast("long"), F.lit(-1)))


def _place(epoch: Column, seed: int) -> Column:
    return F.xxhash64("doc_id", F.lit(seed) + epoch)


def plan(slim: DataFrame, settings: Settings) -> DataFrame:
    """For each leaf its full epochs, and the place (``stop_at``, ``stop_id``) in the next epoch before which the
    prefix ends; null where nothing is left out. ``slim`` has (domain, lang, source, doc_id, tokens)."""
    leaves = shared_table(
        budgets(slim.groupBy(*LEAF).agg(F.sum("tokens").alias("available")), settings).withColumn(
            "epochs", F.when(F.col("available") > 0, F.least(F.expr("budget div available"), F.lit(settings.max_epochs))).otherwise(1)
        ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available")), "leaves",
    )
    open_leaves = leaves.where((F.col("epochs") < settings.max_epochs) & (F.col("available") > 0)).select(*LEAF, "epochs", "rest")
    small = leaves.count() <= settings.broadcast_leaves
    rows = slim.join(F.broadcast(open_leaves) if small else open_leaves, LEAF).withColumn("at", _place(F.col("epochs"), settings.seed))
    # Unsigned order of the hash, from its first byte on.
    rows = rows.withColumn("at", F.col("at").bitwiseXOR(F.lit(-(1 << 63)))).select(*LEAF, "doc_id", "tokens", "at", "rest")
    for level in range(2):
        byte = F.shiftrightunsigned("at", 56 - 8 * level).bitwiseAND(255)
        rows = rows.withColumn("range", byte)
        sums = rows.groupBy(*LEAF, "range").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
        running = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("range"))
        ends = sums.withColumn("upto", running).where("upto > rest").groupBy(*LEAF).agg(
            F.min(F.struct("range", (F.col("rest") - (F.col("upto") - F.col("tokens"))).alias("left"))).alias("end")
        )
        ends = ends.select(*LEAF, F.col("end.range").alias("range"), F.col("end.left").alias("left"))
        rows = rows.drop("rest").join(F.broadcast(ends) if small else ends, [*LEAF, "range"]).withColumnRenamed("left", "rest").drop("range")
    same = rows.groupBy(*LEAF, "at", "doc_id").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy(F.col("at").bitwiseXOR(F.lit(-(1 << 63))), "doc_id"))
    stops = same.withColumn("upto", running).where("upto > rest").groupBy(*LEAF).agg(
        F.min(F.struct(F.col("at").bitwiseXOR(F.lit(-(1 << 63))).alias("at"), F.col("doc_id").alias("id"))).alias("stop")
    )
    return leaves.join(stops, LEAF, "left").select(
        *LEAF, "available", "budget", "epochs", F.col("stop.at").alias("stop_at"), F.col("stop.id").alias("stop_id"),
    )


def mix(
    docs: DataFrame, settings: Settings, id_column: str = "doc_id", lang_column: str = "lang",
    source_column: str = "source", text_column: str = "text",
) -> DataFrame:
    """The selected rows with all their columns; a row selected in several epochs comes that many times.

    Null languages and sources form a leaf of their own; rows without an id share one place in each epoch, as
    do rows with the same id, and are selected together. Null and empty texts have no tokens. Leaves without
    tokens are kept whole; leaves of weight 0 are left out.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {k: f"c{names.index(v)}" for k, v in (("id", id_column), ("lang", lang_column), ("source", source_column), ("text", text_column))}
    marked = _with_leaf(plain, settings, at["id"], at["lang"], at["source"])
    slim = shared_table(marked.select(*LEAF, "doc_id", tokens_of(F.col(at["text"])).alias("tokens")), "slim")
    leaves = shared_table(plan(slim, settings), "plan")
    small = leaves.count() <= settings.broadcast_leaves
    joined = marked.join(F.broadcast(leaves) if small else leaves, LEAF)
    place = _place(F.col("epochs"), settings.seed)
    inside = F.col("stop_at").isNull() | (place < F.col("stop_at")) | ((place == F.col("stop_at")) & (F.col("doc_id") < F.col("stop_id")))
    times = F.col("epochs") + F.when((F.col("epochs") < settings.max_epochs) & inside & (F.col("available") > 0), 1).otherwise(0)
    chosen = joined.withColumn("times", times.cast("int")).where("times > 0")
    if settings.max_epochs > 1:
        chosen = chosen.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return chosen.select(*plain.columns).toDF(*names)
