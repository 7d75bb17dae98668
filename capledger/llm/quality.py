"""Quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled texts. A text is compressed with each,
piece by piece so that no piece learns from its predecessors; the difference of the two sizes over the
text's bytes is its raw value. A logistic curve, fitted on labelled texts that are in neither dictionary,
makes it a probability.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, pick, slices


@dataclass(frozen=True)
class Settings:
    #: Fitting reads at most this many labelled texts of each class ...
    rows_per_class: int = 3000
    #: ... and pieces of them of at most so many bytes: a text gives up to its share, spread evenly over its whole length.
    #: Scoring reads everything.
    bytes_per_class: int = 12 << 20
    dictionary_bytes: int = 256 << 10
    piece_bytes: int = 2048
    level: int = 3
    #: Every so-many-th text fits the curve instead of a dictionary.
    calibration_every: int = 4


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    settings: Settings = field(default_factory=Settings)


def _dictionary(texts: Sequence[bytes], settings: Settings) -> bytes:
    """A trained dictionary, or plain content where there is too little to train on."""
    pieces = [t[a:a + settings.piece_bytes] for t in texts for a in range(0, len(t), settings.piece_bytes)]
    size = min(settings.dictionary_bytes, sum(map(len, pieces)) // 8)
    if len(pieces) >= 8 and size >= 1024:
        try:
            return zstandard.train_dictionary(size, pieces).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"\n".join(pieces)[:settings.dictionary_bytes]


class Compressors:
    """The two compressors of a model; ``value`` is positive for what resembles the good texts."""

    def __init__(self, good: bytes, bad: bytes, settings: Settings):
        self.piece = settings.piece_bytes
        self.pair = [
            zstandard.ZstdCompressor(
                level=settings.level, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            ) for raw in (good, bad)
        ]

    def value(self, text: bytes) -> float:
        good, bad = self.pair
        size = 0
        for at in range(0, len(text), self.piece):
            part = text[at:at + self.piece]
            size += len(bad.compress(part)) - len(good.compress(part))
        return size / max(1, len(text))


def _curve(values: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve: Newton's method with a small penalty on the slope."""
    scale = float(values.std()) or 1.0
    x = np.column_stack([values / scale, np.ones(len(values))])
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - good) + 1e-2 * weights * [1, 0]
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hessian, gradient)
        weights = weights - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0] / scale), float(weights[1])


def held_out(id_column: str | Column) -> Column:
    """Rows that learning never sees: crc32 of the id as text leaves 1 when divided by 3. A null id is not one."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sampled(text: bytes, share: int, piece: int) -> bytes:
    """A text of up to ``share`` bytes as it is; of a longer one so many pieces, evenly spread from its start to its end."""
    count = max(1, share // piece)
    if len(text) <= count * piece:
        return text
    starts = np.linspace(0, len(text) - piece, count).astype(np.int64)
    return b"".join(text[at:at + piece] for at in starts.tolist())


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from a bounded sample of the labelled texts, chosen by a hash of their ids.

    Labels other than 0 and 1, rows without an id or a text and held-out rows are left out; of rows that
    share an id and a label one is used. Texts longer than their share of the bytes give pieces, so none
    leaves another one out. Without texts of both classes every score is the share of good ones (one half without any), and
    a warning tells so.
    """
    known = (
        pick(labels, ("doc_id", "long"), ("quality", "int")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out("doc_id")).distinct()
    )
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = known.limit(0)
    for value in (0, 1):
        chosen = chosen.union(known.where(F.col("quality") == value).orderBy(*order).limit(settings.rows_per_class))
    texts = (
        pick(docs, ("doc_id", "long"), ("text", "string")).where("text <> ''")
        .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    )
    counted = {r["quality"]: r["n"] for r in texts.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    shares = {q: settings.bytes_per_class // n for q, n in counted.items()}

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [
                    sampled(t, shares.get(q, 0), settings.piece_bytes)
                    for q, t in zip(part.column(0).to_pylist(), byte_texts(part.column(1)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary()), part.column(2)], names=["quality", "text", "doc_id"])

    rows = texts.select("quality", "text", "doc_id").mapInArrow(run, "quality int, text binary, doc_id long").withColumn(
        "at", F.xxhash64("doc_id")
    ).collect()
    rows.sort(key=lambda r: (r["at"], r["doc_id"]))
    by_class: list[list[bytes]] = [[], []]
    for row in rows:
        by_class[row["quality"]].append(bytes(row["text"]))
    if not by_class[0] or not by_class[1]:
        warnings.warn("labelled texts of one class are missing: every text gets the same score", stacklevel=2)
    return train(by_class[1], by_class[0], settings)


def train(good: Sequence[bytes], bad: Sequence[bytes], settings: Settings = Settings()) -> Model:
    """A model from texts of the two classes."""
    if not good or not bad:
        share = (len(good) + 1) / (len(good) + len(bad) + 2)
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))), settings)
    every = settings.calibration_every
    learn = [[t for i, t in enumerate(texts) if i % every or len(texts) < every] for texts in (good, bad)]
    check = [texts[::every] for texts in (good, bad)]
    dictionaries = [_dictionary(texts, settings) for texts in learn]
    compressors = Compressors(*dictionaries, settings)
    values = np.array([compressors.value(t) for texts in check for t in texts])
    truth = np.array([1.0] * len(check[0]) + [0.0] * len(check[1]))
    return Model(*dictionaries, *_curve(values, truth), settings)


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Each row's id, raw value and score from 0 to 1 (higher: the label 1 is likelier).

    Whole texts count. Null and empty texts have the raw value 0 and its score. Rows are scored one by one:
    repeated rows and null ids are kept. Other columns are left out and never looked at.
    """
    rows = pick(docs, (id_column, "long"), (text_column, "string"))
    return _with_value(rows, model, 1).select(id_column, "value", _score(model).alias("score"))


def keep_good(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kept = _with_value(plain, model, names.index(text_column)).where(_score(model) >= threshold)
    return kept.drop("value").toDF(*names)


def _score(model: Model) -> Column:
    return 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("value") + F.lit(model.offset))))


def _with_value(rows: DataFrame, model: Model, at: int) -> DataFrame:
    """The rows with a further column ``value``; ``at`` is the place of the text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        compressors = Compressors(shared.value.good, shared.value.bad, shared.value.settings)
        for batch in batches:
            for part in slices(batch, 1024):
                values = pa.array([compressors.value(t) for t in byte_texts(part.column(at))], pa.float64())
                yield part.append_column("value", values)

    return rows.mapInArrow(run, rows.withColumn("value", F.lit(0.0)).schema)
