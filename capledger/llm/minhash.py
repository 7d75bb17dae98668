"""Near-duplicates by circulant MinHash, confirmed on full sets.

A text's distinct word shingles become 64-bit marks. One permutation scatters them over the circle of 32-bit
numbers, a second one ranks the places of that circle; signature coordinate ``k`` is the smallest rank after
all places have been shifted by ``k``. Bands of coordinates put texts into buckets.

Texts with equal sets form a class at once. Class representatives that share a bucket are linked if they meet
the threshold on their full sets. First each bucket's members are compared with one centre per round,
which joins large groups by as many comparisons as they have members; then, in the buckets that still hold
several components, all members of different components are compared. Components join what is linked.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_texts, components, drop_shared, pick, shared_table, slices


@dataclass(frozen=True)
class Settings:
    words: int = 5
    #: Sets are linked if 100 * intersection >= percent * union.
    percent: int = 80
    #: A pair at the threshold shares no bucket with probability (1 - 0.8 ** rows) ** bands, here below 1e-6.
    bands: int = 38
    rows: int = 5
    #: Rounds in which each bucket's members are compared with one centre.
    rounds: int = 2
    #: Words of 64 bits in the parity sketch, which rules out pairs that cannot be linked.
    sketch_words: int = 16


FEATURES = (
    "row_id long, n_shingles long, set_low long, set_high long, buckets array<long>, sketch array<long>"
)


def _mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def _mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordMarks:
    """64-bit marks of words, kept while they are not too many."""

    def __init__(self, limit: int = 500_000):
        self.known: dict[bytes, int] = {}
        self.limit = limit

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: bytes, width: int, marks: WordMarks) -> np.ndarray:
    """Sorted marks of the distinct shingles of ``width`` words; of all words if there are fewer; else none.

    A-Z are lower-cased; words are what stands between blanks, tabs and line ends.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = marks(words)
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mix64(total + each[k:len(each) - width + 1 + k])
    return np.unique(total)


def signature(marks: np.ndarray, length: int) -> np.ndarray:
    """Circulant MinHash: both permutations are fixed, coordinate k ranks the places shifted by k."""
    places = _mix32((marks ^ (marks >> np.uint64(32))).astype(np.uint32))
    shifts = np.arange(1, length + 1, dtype=np.uint32)[:, None]
    best = np.full(length, 0xFFFFFFFF, np.uint32)
    step = max(1, (1 << 17) // length)
    for at in range(0, len(places), step):
        np.minimum(best, _mix32(places[None, at:at + step] + shifts).min(axis=1), out=best)
    return best


def _bands(best: np.ndarray, settings: Settings) -> np.ndarray:
    """One 64-bit key for each band, its number included."""
    rows = best[:settings.bands * settings.rows].reshape(settings.bands, settings.rows).astype(np.uint64)
    keys = np.arange(1, settings.bands + 1, dtype=np.uint64)
    for k in range(settings.rows):
        keys = _mix64(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return keys.view(np.int64)


def _sketch(marks: np.ndarray, words: int) -> np.ndarray:
    """For each of so many cells of the marks whether an odd number lies in it.

    Two sets differ in at least as many marks as their sketches differ in bits.
    """
    odd = np.bincount((marks >> np.uint64(32)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def features(rows: DataFrame, settings: Settings) -> DataFrame:
    """FEATURES of each row of (row_id, text)."""
    length = settings.bands * settings.rows

    def run(batches):
        marks = WordMarks()
        for batch in batches:
            for part in slices(batch, 1024):
                sizes, low, high, buckets, sketches = [], [], [], [], []
                for text in byte_texts(part.column(1)):
                    own = shingles(text, settings.words, marks)
                    sizes.append(len(own))
                    if not len(own):
                        low.append(None), high.append(None), buckets.append(None), sketches.append(None)
                        continue
                    raw = own.tobytes()
                    digest = xxhash.xxh3_128_intdigest(raw)
                    low.append((digest & (1 << 64) - 1) - (1 << 63))
                    high.append((digest >> 64) - (1 << 63))
                    best = signature(own, length)
                    buckets.append(_bands(best, settings))
                    sketches.append(_sketch(own, settings.sketch_words))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(sizes, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                    pa.array(buckets, longs), pa.array(sketches, longs),
                ], names=["row_id", "n_shingles", "set_low", "set_high", "buckets", "sketch"])

    return rows.mapInArrow(run, FEATURES)


def _possible(settings: Settings) -> Column:
    """Sizes and sketches of a pair (n_a, n_b, sketch_a, sketch_b) do not rule the link out.

    Exact: with a similarity of s or more, two sets differ in at most (1 - s) / (1 + s) of their sizes' sum.
    """
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * settings.percent
    a, b = F.col("sketch_a"), F.col("sketch_b")
    differing = sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(settings.sketch_words)), F.lit(0))
    return sizes & (differing * (100 + settings.percent) <= (F.col("n_a") + F.col("n_b")) * (100 - settings.percent))


def with_likely(rows: DataFrame, ids: DataFrame, bits: int = 1 << 22) -> DataFrame:
    """The rows with ``likely``: true where row_id is in ``ids``, seldom elsewhere.

    A bit set of fixed size, broadcast in 64-bit words, so that rows need no shuffle to be told apart.
    """
    place = F.pmod(F.xxhash64("row_id"), F.lit(bits))
    words = ids.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(row_id), {bits}L) & 63 as int))")).alias("bits")
    )
    marked = rows.join(F.broadcast(words), F.shiftright(place, 6) == F.col("word"), "left")
    likely = F.coalesce(F.getbit("bits", place.bitwiseAND(63).cast("int")) == 1, F.lit(False))
    return marked.withColumn("likely", likely).drop("word", "bits")


def confirmed(pairs: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of distinct row ids whose full sets meet the threshold; ``rows`` has (row_id, text).

    The texts of the rows that occur are joined to their pairs twice, so a task holds two texts at a time
    and the sets of the last few.
    """
    occurring = pairs.select(F.col("a").alias("row_id")).union(pairs.select("b")).distinct()
    texts = with_likely(rows, occurring).where("likely").drop("likely").join(occurring, "row_id", "left_semi")
    both = (
        pairs.join(texts.select(F.col("row_id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("row_id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches):
        marks, known = WordMarks(), OrderedDict()

        def set_of(row_id, text):
            found = known.pop(row_id, None)
            if found is None:
                found = shingles(text, settings.words, marks)
                while len(known) >= 64:
                    known.popitem(last=False)
            known[row_id] = found
            return found

        for batch in batches:
            for part in slices(batch, 256):
                a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                keep = []
                for i, (text_a, text_b) in enumerate(zip(byte_texts(part.column(2)), byte_texts(part.column(3)), strict=True)):
                    x, y = set_of(a[i], text_a), set_of(b[i], text_b)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if shared * 100 >= settings.percent * (len(x) + len(y) - shared):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keep, pa.int64())), part.column(1).take(pa.array(keep, pa.int64()))],
                    names=["a", "b"],
                )

    return both.mapInArrow(run, "a long, b long")


def _candidates(current: DataFrame, heads: DataFrame, settings: Settings, turn: int) -> DataFrame:
    """Distinct pairs of different components to be confirmed in one round; ``current`` has (row_id, bucket, component)."""
    def with_sketch(pairs: DataFrame, column: str) -> DataFrame:
        own = heads.select(F.col("row_id").alias(column), F.col("n").alias(f"n_{column}"), F.col("sketch").alias(f"sketch_{column}"))
        return pairs.join(own, column)

    order = F.xxhash64("row_id", F.lit(turn))
    mixed = current.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.min_by("row_id", order).alias("centre"), F.min_by("component", order).alias("of_centre"),
    ).where("least < most")
    if turn < settings.rounds:
        pairs = current.join(mixed, "bucket").where("component <> of_centre").select(
            F.greatest("row_id", "centre").alias("a"), F.least("row_id", "centre").alias("b")
        ).distinct()
        return with_sketch(with_sketch(pairs, "a"), "b").where(_possible(settings)).select("a", "b")
    members = current.join(mixed.select("bucket"), "bucket").select("bucket", "component", F.col("row_id").alias("a"))
    members = with_sketch(members, "a")
    others = members.select(
        "bucket", F.col("component").alias("other"), F.col("a").alias("b"), F.col("n_a").alias("n_b"),
        F.col("sketch_a").alias("sketch_b"),
    )
    pairs = members.join(others, "bucket").where((F.col("component") < F.col("other")) & _possible(settings))
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def link(rows: DataFrame, settings: Settings) -> DataFrame:
    """(row_id, n_shingles, component) of each row of (row_id, text).

    ``component`` is the smallest row id reachable over links. Texts without words are linked with nothing;
    rows without an id have no component.
    """
    named = rows.where("row_id IS NOT NULL")
    table = shared_table(features(rows, settings), "features")
    classes = table.where("n_shingles > 0 AND row_id IS NOT NULL").groupBy("set_low", "set_high").agg(F.min("row_id").alias("row_id"))
    heads = shared_table(
        table.where("n_shingles > 0").join(classes.select("row_id").distinct(), "row_id", "left_semi")
        .dropDuplicates(["row_id"]).select("row_id", F.col("n_shingles").alias("n"), "sketch", "buckets"), "heads",
    )
    # Class representatives in each of their buckets, as far as another one is there too.
    entries = heads.select("row_id", F.explode("buckets").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
    entries = shared_table(entries.join(crowded, "bucket"), "entries")

    links = joined = None
    for turn in range(settings.rounds + 1):
        if joined is None:
            current = entries.withColumn("component", F.col("row_id"))
        else:
            current = entries.join(joined, F.col("row_id") == F.col("node"), "left").select(
                "row_id", "bucket", F.coalesce("component", "row_id").alias("component")
            )
        pairs = shared_table(_candidates(current, heads, settings, turn), "pairs")
        found = confirmed(pairs, named, settings)
        links = shared_table(found if links is None else links.union(found), "links")
        drop_shared(pairs)
        joined = components(links)

    ends = classes.join(joined, F.col("row_id") == F.col("node"), "left").select(
        "set_low", "set_high", F.coalesce("component", "row_id").alias("component")
    )
    component = F.when(F.col("row_id").isNotNull(), F.coalesce("component", "row_id"))
    return table.join(ends, ["set_low", "set_high"], "left").select("row_id", "n_shingles", component.alias("component"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text).

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing. Rows without
    a doc_id take no part: they come back with a null component_id and are kept. Repeated rows come back as
    often as they occur. Other columns are left out.
    """
    rows = pick(docs, ("doc_id", "long"), ("text", "string")).withColumnRenamed("doc_id", "row_id")
    return link(rows, settings).select(
        F.col("row_id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("row_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group of near-duplicates, with all their columns.

    The document with the smallest id stays. Of rows with the same id one stays, that with the smallest text.
    Rows without an id stay. Only rows that may have to go are shuffled.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_at, text_at = f"c{names.index(id_column)}", f"c{names.index(text_column)}"
    judged = near_duplicates(plain.select(F.col(id_at).alias("doc_id"), F.col(text_at).alias("text")), settings)
    judged = shared_table(
        judged.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("row_id")).agg(
            F.max("kept").alias("kept"), F.count("*").alias("rows")
        ).where("NOT kept OR rows > 1"), "judged",
    )
    marked = with_likely(plain.withColumn("row_id", F.col(id_at).cast("long")), judged)
    rest = marked.where("likely").join(judged.where("NOT kept").select("row_id"), "row_id", "left_anti")
    first = F.row_number().over(Window.partitionBy("row_id").orderBy(text_at))
    rest = rest.withColumn("place", first).where("place = 1")
    return marked.where("NOT likely").select(*plain.columns).union(rest.select(*plain.columns)).toDF(*names)
