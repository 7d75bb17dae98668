"""Embedding near-duplicates by an epsilon grid order join.

A cosine of at least ``c`` means a distance of at most ``eps = sqrt(2 - 2c)`` between unit vectors. Vectors are
sorted by their cells in a grid of that width over the leading principal dimensions and cut into blocks; the
blocks are the leaves of a tree of sequence intervals. Starting from the whole sequence, pairs of intervals
are split as long as they are undecided: a pair whose boxes lie further apart than ``eps`` is skipped, a pair
whose balls lie within ``eps`` altogether is linked without looking at its vectors, and pairs of blocks that
stay undecided are compared vector by vector in double precision.

Copies are compared once: equal vectors of a label form a class beforehand.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, pick, shared_table
from .vectors import matrix, usable


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.98
    #: Leading principal dimensions, and how many vectors they are fitted on. Any basis gives the same links.
    dimensions: int = 8
    fit_rows: int = 8192
    block_rows: int = 256
    #: Children of an interval.
    fan: int = 16


#: Room for rounding when distances are compared with eps.
SLACK = 1e-9

NODE = (
    "group_id string, number long, low array<double>, high array<double>, centre array<double>, radius double, "
    "members long, copies long, anchor long"
)


def principal(sample: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading principal directions of a sample, as columns."""
    if len(sample) < 2:
        return np.eye(sample.shape[1] if sample.ndim == 2 else 1)[:, :dimensions]
    _, _, rows = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=False)
    return rows[:dimensions].T


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that no square overflows or vanishes.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _basis(bases: dict[int, np.ndarray], width: int, dimensions: int) -> np.ndarray:
    return bases[width] if width in bases else np.eye(width)[:, :dimensions]


def _ordered(classes: DataFrame, settings: Settings, eps: float) -> DataFrame:
    """Classes with their grid cells; the basis is fitted for the width most of a bounded sample has."""
    sample = classes.select("vector").orderBy(F.xxhash64("id"), "id").limit(settings.fit_rows).collect()
    widths: dict[int, list] = {}
    for (vector,) in sample:
        widths.setdefault(len(vector), []).append(vector)
    bases = {w: principal(_units(np.array(v, np.float64)), settings.dimensions) for w, v in widths.items()}
    names = [f"cell_{k}" for k in range(settings.dimensions)]

    def run(batches):
        for batch in batches:
            widths = batch.column("width").to_numpy()
            cells = np.zeros((batch.num_rows, settings.dimensions), np.int64)
            for width in np.unique(widths).tolist():
                at = np.nonzero(widths == width)[0]
                part = matrix(batch.column("vector").take(pa.array(at)), width)
                found = _units(part) @ _basis(bases, width, settings.dimensions)
                cells[at, :found.shape[1]] = np.floor(found / eps)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(cells[:, k]) for k in range(settings.dimensions)]],
                names=[*batch.schema.names, *names],
            )

    kinds = ", ".join(f"{n} long" for n in names)
    cells = classes.mapInArrow(run, f"group_id string, width int, id long, copies long, vector array<double>, {kinds}")
    order = ["group_id", *names, "id"]
    ordered = cells.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches):
        part, number, held = TaskContext.get().partitionId(), 0, None

        def blocks(table: pa.RecordBatch, last: bool):
            """Full blocks of one group each; what is left over waits for the next batch."""
            nonlocal number, held
            groups = np.array(table.column("group_id").to_pylist(), object)
            at = 0
            while at < table.num_rows:
                end = min(at + settings.block_rows, table.num_rows)
                other = np.nonzero(groups[at:end] != groups[at])[0]
                whole = len(other) > 0 or end - at == settings.block_rows or last
                end = at + int(other[0]) if len(other) else end
                if not whole:
                    break
                yield _block(table.slice(at, end - at), (part << 32) + number, bases, settings)
                number, at = number + 1, end
            held = table.slice(at) if at < table.num_rows else None

        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            yield from blocks(batch, False)
        if held is not None:
            yield from blocks(held, True)

    return ordered.mapInArrow(cut, f"{NODE}, ids binary, counts binary, vectors binary")


def _block(rows: pa.RecordBatch, number: int, bases, settings: Settings) -> pa.RecordBatch:
    width = rows.column("width")[0].as_py()
    vectors = matrix(rows.column("vector"), width)
    units = _units(vectors)
    seen = units @ _basis(bases, width, settings.dimensions)
    centre = units.mean(axis=0)
    ids, counts = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
    doubles = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays([
        pa.array([rows.column("group_id")[0].as_py()]), pa.array([number], pa.int64()),
        pa.array([seen.min(axis=0).tolist()], doubles), pa.array([seen.max(axis=0).tolist()], doubles),
        pa.array([centre.tolist()], doubles),
        pa.array([float(np.sqrt(((units - centre) ** 2).sum(axis=1)).max())]), pa.array([rows.num_rows], pa.int64()),
        pa.array([int(counts.sum())], pa.int64()), pa.array([int(ids[0])], pa.int64()),
        pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([counts.astype(np.int64).tobytes()], pa.binary()),
        pa.array([vectors.tobytes()], pa.binary()),
    ], names=["group_id", "number", "low", "high", "centre", "radius", "members", "copies", "anchor", "ids", "counts", "vectors"])


def _parents(nodes: DataFrame, fan: int) -> DataFrame:
    """The intervals above: box and ball around at most ``fan`` children."""
    def merge(pdf):
        low, high = np.array(pdf.low.tolist()), np.array(pdf.high.tolist())
        centres = np.array(pdf.centre.tolist())
        centre = (centres * pdf.members.to_numpy()[:, None]).sum(axis=0) / pdf.members.sum()
        radius = (np.sqrt(((centres - centre) ** 2).sum(axis=1)) + pdf.radius).max()
        first = pdf.iloc[[0]].copy()
        first["low"], first["high"], first["centre"] = [low.min(axis=0)], [high.max(axis=0)], [centre]
        first["radius"], first["members"], first["copies"] = radius, pdf.members.sum(), pdf.copies.sum()
        first["anchor"] = pdf.anchor.min()
        return first

    up = nodes.select("group_id", F.expr(f"number div {fan}").alias("number"), *nodes.columns[2:])
    return up.groupBy("group_id", "number").applyInPandas(merge, NODE)


def _decide(pairs: DataFrame, nodes: DataFrame, eps: float) -> DataFrame:
    """Pairs of intervals (group_id, a, b) that are not provably distant; ``near`` where all of it is linked."""
    def side(name: str) -> DataFrame:
        return nodes.select("group_id", F.col("number").alias(name), *[
            F.col(c).alias(f"{c}_{name}") for c in ("low", "high", "centre", "radius", "copies", "anchor")
        ])

    both = pairs.join(side("a"), ["group_id", "a"]).join(side("b"), ["group_id", "b"])
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        ), F.lit(0.0), lambda total, x: total + x * x,
    )
    apart = F.sqrt(F.aggregate(
        F.zip_with("centre_a", "centre_b", lambda x, y: x - y), F.lit(0.0), lambda total, x: total + x * x,
    ))
    reach = F.col("radius_a") + F.col("radius_b")
    far = (F.sqrt(gap) > eps * (1 + SLACK) + SLACK) | (apart - reach > eps * (1 + SLACK) + SLACK)
    return both.where(~far).select(
        "group_id", "a", "b", "copies_a", "copies_b", "anchor_a", "anchor_b",
        (apart + reach < eps * (1 - SLACK) - SLACK).alias("near"),
    )


def _compare(a: tuple, b: tuple, same: bool, cosine: float) -> list[tuple[int, int, int]]:
    """(id, linked copies, an id of the same component) of the vectors of two blocks that have a link."""
    (ids_a, counts_a, x), (ids_b, counts_b, y) = a, b
    # A power of two brings each vector's largest component near one and changes no digit of it.
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, initial=0))[1][:, None]) for v in (x, y))
    norm = lambda v: np.sqrt((v * v).sum(axis=1))
    linked = (x @ y.T) / norm(x)[:, None] / norm(y)[None, :] >= cosine
    if same:
        np.fill_diagonal(linked, True)
        linked |= linked.T
    rows, columns = linked.any(axis=1), linked.any(axis=0)
    # The least id reachable inside the two blocks, by passing minima back and forth.
    least_a, least_b, top = ids_a.copy(), ids_b.copy(), np.iinfo(np.int64).max
    while True:
        next_a = np.minimum(least_a, np.where(linked, least_b[None, :], top).min(axis=1))
        next_b = np.minimum(least_b, np.where(linked, next_a[:, None], top).min(axis=0))
        if (next_a == least_a).all() and (next_b == least_b).all():
            break
        least_a, least_b = next_a, next_b
    out = list(zip(ids_a[rows].tolist(), (linked @ counts_b)[rows].tolist(), least_a[rows].tolist(), strict=True))
    if not same:
        out += zip(ids_b[columns].tolist(), (counts_a @ linked)[columns].tolist(), least_b[columns].tolist(), strict=True)
    return out


def _compared(pairs: DataFrame, blocks: DataFrame, cosine: float) -> DataFrame:
    def side(name: str) -> DataFrame:
        return blocks.select("group_id", F.col("number").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("ids", "counts", "vectors")])

    def block(batch, row: int, name: str) -> tuple:
        ids = np.frombuffer(batch.column(f"ids_{name}")[row].as_py(), np.int64)
        counts = np.frombuffer(batch.column(f"counts_{name}")[row].as_py(), np.int64)
        return ids, counts, np.frombuffer(batch.column(f"vectors_{name}")[row].as_py(), np.float64).reshape(len(ids), -1)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                same = batch.column("a")[row].as_py() == batch.column("b")[row].as_py()
                found = _compare(block(batch, row, "a"), block(batch, row, "b"), same, cosine)
                columns = zip(*found, strict=True) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["id", "linked", "anchor"])

    both = pairs.select("group_id", "a", "b").join(side("a"), ["group_id", "a"]).join(side("b"), ["group_id", "b"])
    return both.mapInArrow(run, "id long, linked long, anchor long")


def _links(classes: DataFrame, settings: Settings) -> DataFrame:
    """(id, linked, anchor): parts of the number of rows each class is linked with, itself included."""
    eps = float(np.sqrt(2 - 2 * settings.cosine))
    blocks = shared_table(_ordered(classes, settings, eps), "blocks")
    # Places of blocks in the sequence, without gaps: those of a partition follow those before it.
    counts = blocks.groupBy(F.shiftright("number", 32).alias("part")).agg(F.count("*").alias("n"))
    offsets = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    blocks = shared_table(
        blocks.join(offsets, F.shiftright("number", 32) == F.col("part"))
        .withColumn("number", F.col("before") + F.col("number").bitwiseAND(0xFFFFFFFF)).drop("part", "before"), "blocks",
    )
    levels = [blocks.drop("ids", "counts", "vectors")]
    total = blocks.agg(F.count("*")).first()[0]
    while total > 1:
        levels.append(shared_table(_parents(levels[-1], settings.fan), "intervals"))
        total = -(-total // settings.fan)
    pairs = levels[-1].select("group_id", F.col("number").alias("a"), F.col("number").alias("b"))
    near = None
    for level in range(len(levels) - 1, -1, -1):
        decided = shared_table(_decide(pairs, levels[level], eps), "decided")
        sure = decided.where("near").withColumn("level", F.lit(level))
        near = sure if near is None else near.union(sure)
        pairs = decided.where("NOT near").select("group_id", "a", "b")
        if level:
            children = levels[level - 1].select("group_id", F.expr(f"number div {settings.fan}").alias("up"), "number")
            left = children.select("group_id", F.col("up").alias("a"), F.col("number").alias("child_a"))
            right = children.select("group_id", F.col("up").alias("b"), F.col("number").alias("child_b"))
            pairs = (
                pairs.join(left, ["group_id", "a"]).join(right, ["group_id", "b"]).where("child_a <= child_b")
                .select("group_id", F.col("child_a").alias("a"), F.col("child_b").alias("b"))
            )
    compared = _compared(pairs, blocks, settings.cosine)

    # Intervals that are linked as a whole hand what they have to all vectors below them.
    ends = near.select("group_id", "level", F.col("a").alias("number"), F.col("copies_b").alias("linked"), F.col("anchor_b").alias("anchor"), "b")
    ends = ends.union(near.where("a <> b").select("group_id", "level", "b", "copies_a", "anchor_a", "a")).groupBy(
        "group_id", "level", "number"
    ).agg(F.sum("linked").alias("linked"), F.min("anchor").alias("anchor"))
    place = F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"), F.expr(f"number div {settings.fan ** level}").alias("number"))
        for level in range(len(levels))
    ])).alias("at")
    whole = blocks.select("group_id", "ids", place).select("group_id", "ids", "at.level", "at.number").join(
        ends, ["group_id", "level", "number"]
    ).select("ids", "linked", "anchor")

    def spread(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids), pa.array(np.full(len(ids), row["linked"])), pa.array(np.full(len(ids), row["anchor"])),
                ], names=["id", "linked", "anchor"])

    between = near.select(F.col("anchor_a").alias("id"), F.lit(0).cast("long").alias("linked"), F.col("anchor_b").alias("anchor"))
    return compared.union(whole.mapInArrow(spread, "id long, linked long, anchor long")).union(between)


def near_duplicates(
    vectors: DataFrame, settings: Settings = Settings(), id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """id, n_links, component_id and kept of each row.

    Rows are linked when their labels are equal and not null and their cosine, in double precision, reaches
    the threshold; equal vectors always are. Vectors of different lengths are never linked. Vectors that are
    null, empty, zero or hold null or non-finite components, and rows without an id or label, are linked with
    nothing; without an id the component is null. Repeated rows come back as often as they occur, and each
    counts as a link of the others. Other columns are left out.
    """
    rows = pick(vectors, (id_column, "long"), (vector_column, "array<double>"), (label_column, "string")).toDF("id", "vector", "label")
    group = F.when(
        usable(F.col("vector")) & F.col("id").isNotNull(), F.concat_ws(":", F.size("vector").cast("string"), "label")
    )
    rows = rows.withColumn("group_id", F.when(F.col("label").isNotNull(), group)).drop("label")
    classes = shared_table(
        rows.where("group_id IS NOT NULL").groupBy("group_id", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
        .select("group_id", F.size("vector").alias("width"), "id", "copies", "vector"), "classes",
    )
    links = shared_table(_links(classes, settings), "links")
    joined = components(links.select(F.col("id").alias("a"), F.col("anchor").alias("b")))
    found = classes.select("group_id", "vector", "id").join(
        links.groupBy("id").agg(F.sum("linked").alias("linked")), "id", "left"
    ).join(joined, F.col("id") == F.col("node"), "left").select(
        "group_id", "vector", "linked", F.coalesce("component", "id").alias("component")
    )
    component = F.coalesce("component", "id")
    return rows.join(found, ["group_id", "vector"], "left").select(
        F.col("id").alias(id_column), F.coalesce(F.col("linked") - 1, F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
