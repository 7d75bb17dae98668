"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Coarse centres are fitted on a bounded sample. Every vector's residual to its nearest centre is padded to the
code length, turned by one random rotation and reduced to the signs of its components. With two correction
scalars per vector, its norm and its alignment with its own code, the inner product with any query is
estimated from the packed bits, within an error that shrinks with the code length. The vectors whose upper
bound reaches a query's k-th largest lower bound are reranked on the original vectors.

Codes meet all queries, tile by tile, and bring their vectors along: each task reranks what its own bounds choose
and hands on the k best of each query. Equal vectors are coded once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, shared_table
from .vectors import matrix, usable


@dataclass(frozen=True)
class Settings:
    neighbours: int = 20
    code_bits: int = 512
    #: Half the width of the bounds in standard errors of the estimate.
    errors: float = 1.5
    centres: int = 32
    fit_rows: int = 4096
    seed: int = 7
    #: A tile holds so many queries; so many groups of codes are compared with each tile by tasks of their own.
    query_rows: int = 1024
    code_rows: int = 4096
    groups: int = 8
    #: More groups than that where a group would hold more tiles of codes.
    group_tiles: int = 64


def rotation(width: int, bits: int, seed: int) -> np.ndarray:
    """The first ``width`` rows of a random rotation of ``bits`` dimensions: zero-padding, then turning."""
    gauss = np.random.default_rng(seed).standard_normal((bits, width))
    q, r = np.linalg.qr(gauss)
    return (q * np.sign(np.diag(r))).T


def fit_centres(sample: np.ndarray, count: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from seeded distinct rows."""
    distinct = np.unique(sample, axis=0)
    count = min(count, len(distinct))
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:count]].copy()
    for _ in range(rounds):
        near = nearest(sample, centres)
        for k in range(count):
            if (near == k).any():
                centres[k] = sample[near == k].mean(axis=0)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


class Codes:
    """Encoding of vectors and estimates for queries of one width."""

    def __init__(self, width: int, centres: np.ndarray, settings: Settings):
        self.bits = -(-max(settings.code_bits, width) // 8) * 8
        self.turn = rotation(width, self.bits, settings.seed)
        self.centres = centres
        self.errors = settings.errors

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed signs, and for each row (centre, residual norm, alignment of the residual with its code)."""
        centre = nearest(rows, self.centres)
        residual = rows - self.centres[centre]
        norm = np.sqrt((residual * residual).sum(axis=1))
        turned = residual @ self.turn
        signs = turned >= 0
        aligned = np.abs(turned).sum(axis=1) / np.sqrt(self.bits) / np.where(norm > 0, norm, 1)
        return np.packbits(signs, axis=1), np.column_stack([centre, norm, np.where(norm > 0, aligned, 1)])

    def bounds(self, queries: np.ndarray, packed: np.ndarray, scalars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products (queries x codes) and the half-widths of their bounds."""
        turned = (queries @ self.turn).astype(np.float32) / np.float32(np.sqrt(self.bits))
        signs = np.unpackbits(packed, axis=1).astype(np.float32)
        signs *= 2
        signs -= 1
        centre, norm, aligned = scalars[:, 0].astype(np.int64), scalars[:, 1], scalars[:, 2]
        estimate = (turned @ signs.T) * (norm / aligned).astype(np.float32)[None, :]
        estimate += (queries @ self.centres.T).astype(np.float32)[:, centre]
        spread = norm * np.sqrt(np.maximum(0, 1 - aligned ** 2)) / aligned / np.sqrt(max(1, self.bits - 1))
        length = np.sqrt((queries * queries).sum(axis=1))
        # Single precision adds a little to each side.
        slack = 1e-5 * (length[:, None] * (norm[None, :] + np.abs(self.centres).max(initial=0) * np.sqrt(queries.shape[1])))
        return estimate, (self.errors * length[:, None] * spread[None, :] + slack).astype(np.float32)


def _tiles(classes: DataFrame, settings: Settings) -> tuple[DataFrame, dict]:
    """Blocks of codes (width, kind 1) and of queries (kind 0), and what decodes them."""
    sample = classes.select("vector").orderBy(F.xxhash64("id"), "id").limit(settings.fit_rows).collect()
    by_width: dict[int, list] = {}
    for (vector,) in sample:
        by_width.setdefault(len(vector), []).append(vector)
    centres = {w: fit_centres(np.array(v, np.float64), settings.centres, settings.seed) for w, v in by_width.items()}

    def run(batches):
        known: dict[int, Codes] = {}
        held: dict[tuple[int, int], list] = {}

        def block(kind: int, width: int, ids: np.ndarray, rows: np.ndarray):
            if width not in known:
                known[width] = Codes(width, centres.get(width, np.zeros((1, width))), settings)
            with np.errstate(over="ignore"):
                single = rows.astype(np.float32)
            data = single.tobytes() if (single == rows).all() else rows.tobytes()
            code, more = (x.tobytes() for x in known[width].encode(rows)) if kind else (b"", b"")
            return pa.RecordBatch.from_arrays([
                pa.array([width], pa.int32()), pa.array([kind], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                pa.array([data], pa.binary()), pa.array([code], pa.binary()), pa.array([more], pa.binary()),
            ], names=["width", "kind", "ids", "data", "code", "more"])

        def full(key: tuple[int, int], limit: int):
            ids = np.concatenate([p[0] for p in held[key]])
            rows = np.concatenate([p[1] for p in held[key]])
            at = 0
            while len(ids) - at >= limit:
                yield block(key[0], key[1], ids[at:at + limit], rows[at:at + limit])
                at += limit
            held[key] = [(ids[at:], rows[at:])]

        sizes = {0: settings.query_rows, 1: settings.code_rows}
        for batch in batches:
            widths, asks = batch.column("width").to_numpy(), np.array(batch.column("asks").to_pylist(), bool)
            ids = batch.column("id").to_numpy()
            for width in np.unique(widths).tolist():
                at = np.nonzero(widths == width)[0]
                rows = matrix(batch.column("vector").take(pa.array(at)), width)
                for kind, own in ((1, np.ones(len(at), bool)), (0, asks[at])):
                    held.setdefault((kind, width), []).append((ids[at][own], rows[own]))
                    yield from full((kind, width), sizes[kind])
        for (kind, width), parts in held.items():
            ids, rows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            if len(ids):
                yield block(kind, width, ids, rows)

    blocks = classes.select("width", "id", "asks", "vector").mapInArrow(
        run, "width int, kind int, ids binary, data binary, code binary, more binary"
    )
    return shared_table(blocks, "tiles"), centres


def _vectors(data: bytes, rows: int, width: int) -> np.ndarray:
    """Vectors of a tile, stored in single precision where that loses nothing."""
    kind = np.float32 if len(data) == 4 * rows * width else np.float64
    return np.frombuffer(data, kind).reshape(rows, width).astype(np.float64)


class Best:
    """The best candidates of each query of a tile so far, by exact inner products, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, wanted: int):
        self.queries, self.wanted = queries, wanted
        self.edge = np.full(len(queries), -np.inf, np.float32)
        self.lowest = np.full((len(queries), wanted), -np.inf, np.float32)
        self.query, self.other, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, estimate: np.ndarray, half: np.ndarray) -> None:
        """Rerank those of a block whose upper bound reaches what the k best are known to have."""
        both = np.concatenate([self.lowest, estimate - half], axis=1)
        self.lowest = np.partition(both, both.shape[1] - self.wanted, axis=1)[:, -self.wanted:]
        edge = np.maximum(self.edge, self.lowest.min(axis=1))
        query, other = np.nonzero(estimate + half >= edge[:, None])
        score = np.concatenate([
            (self.queries[query[at:at + 65536]] * vectors[other[at:at + 65536]]).sum(axis=1) for at in range(0, len(query), 65536)
        ] or [np.zeros(0)])
        query, other = np.concatenate([self.query, query]), np.concatenate([self.other, ids[other]])
        score = np.concatenate([self.score, score])
        order = np.lexsort((other, -score, query))
        query, other, score = query[order], other[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.wanted
        self.query, self.other, self.score = query[kept], other[kept], score[kept]
        last = place == self.wanted - 1
        # One step down in single precision, so that what equals the edge still reaches it.
        with np.errstate(over="ignore"):
            self.edge[query[last]] = np.nextafter(score[last].astype(np.float32), np.float32(-np.inf))


def _nearest(classes: DataFrame, settings: Settings) -> DataFrame:
    """(query, id, score): for each query and group of codes the best reranked classes, one more than asked for."""
    tiles, centres = _tiles(classes, settings)
    # Every tile of queries meets every group of codes: each side is copied once for each part of the other.
    queries = tiles.where("kind = 0").withColumn("tile", F.xxhash64("width", "ids"))
    names = shared_table(queries.select("width", "tile"), "names")
    number = max(settings.groups, -(-tiles.where("kind = 1").count() // settings.group_tiles))
    groups = F.sequence(F.lit(0), F.lit(number - 1))
    left = queries.select("width", "tile", F.explode(groups).alias("part"), "kind", "ids", "data", "code", "more")
    right = (
        tiles.where("kind = 1").withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(number)).cast("int"))
        .join(names, "width").select("width", "tile", "part", "kind", "ids", "data", "code", "more")
    )
    dealt = left.union(right).repartition("tile", "part").sortWithinPartitions("tile", "part", "kind", "ids")
    wanted = settings.neighbours + 1  # a query may find itself

    def run(batches):
        known: dict[int, Codes] = {}
        key, ids, best = None, None, None

        def flush():
            if best is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[best.query]), pa.array(best.other), pa.array(best.score)], names=["query", "id", "score"],
                )

        for batch in batches:
            for row in range(batch.num_rows):
                width, tile, part, kind, raw, data, code, more = (c[row].as_py() for c in batch.columns)
                own = np.frombuffer(raw, np.int64)
                if kind == 0:
                    if (tile, part) != key:
                        yield from flush()
                        key, ids, best = (tile, part), own, Best(_vectors(data, len(own), width), wanted)
                    continue
                if width not in known:
                    known[width] = Codes(width, centres.get(width, np.zeros((1, width))), settings)
                packed = np.frombuffer(code, np.uint8).reshape(len(own), -1)
                bounds = known[width].bounds(best.queries, packed, np.frombuffer(more, np.float64).reshape(len(own), -1))
                best.meet(own, _vectors(data, len(own), width), *bounds)
        yield from flush()

    return dealt.mapInArrow(run, "query long, id long, score double")


def search(
    vectors: DataFrame, queries: Callable[[Column], Column], settings: Settings = Settings(), id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows of each row that ``queries`` selects by its id.

    Nearest first, ties to the smaller id; a row is no neighbour of itself. Only vectors of the query's length
    are candidates. Vectors that are null, empty, zero or hold null or non-finite components, and rows without
    an id, take no part. Repeated rows (same id and vector) count as one. Other columns are left out.
    """
    rows = pick(vectors, (id_column, "long"), (vector_column, "array<double>")).toDF("member", "vector").where(
        F.col("member").isNotNull() & usable(F.col("vector"))
    )
    asks = F.col("member").isNotNull() & F.coalesce(queries(F.col("member")), F.lit(False))
    rows = rows.withColumn("asks", asks)
    classes = shared_table(
        rows.groupBy("vector").agg(F.min("member").alias("id"), F.max("asks").alias("asks"))
        .select(F.size("vector").alias("width"), "id", "asks", "vector"), "classes",
    )
    # Of each class the smallest ids suffice: one more than asked for, as a query leaves itself out.
    wanted = settings.neighbours + 1
    named = rows.join(classes.select("vector", "id"), "vector").select("id", "member", "asks")
    by_member = Window.partitionBy("id").orderBy("member")
    members = shared_table(
        named.select("id", "member").withColumn("place", F.dense_rank().over(by_member)).where(F.col("place") <= wanted)
        .select("id", "member").distinct(), "members",
    )
    scored = _nearest(classes, settings)
    # Whole classes first, then members: no class beyond the wanted-th can hold a neighbour.
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = scored.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= wanted)
    near = best.join(members, "id").select("query", F.struct((-F.col("score")).alias("order"), F.col("member").alias("vec_id")).alias("hit"))
    lists = near.groupBy("query").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    asked = named.where("asks").select(F.col("id").alias("query"), F.col("member").alias("query_id")).distinct()
    result = asked.join(lists, "query").select(
        "query_id", F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, settings.neighbours).alias("hits")
    )
    return result.select("query_id", F.posexplode("hits").alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.order")).alias("score"),
    )
