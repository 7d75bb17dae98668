"""Helpers shared by the operators: column picking, shared tables, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capledger.session import checkpoint_root


#: Rows of texts that go to a Python worker at a time; Spark's own number suits short rows.
BATCH_ROWS, _BATCH_SETTING = 1024, "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession) -> None:
    """Let Arrow batches of the session hold fewer rows, so that several long texts do not fill a worker; a smaller
    number that has been set is kept."""
    if int(spark.conf.get(_BATCH_SETTING, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def pick(df: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, each cast to a type: ``pick(df, ("doc_id", "long"))``.

    Names are compared exactly and the first match counts, so that further columns whose names
    differ by case only, or occur twice, do no harm.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(name)}").cast(kind).alias(name) for name, kind in columns])


def run_folder(spark: SparkSession) -> str:
    """The folder below ``spark.checkpoint.dir`` that holds all this application writes in between."""
    return f"{checkpoint_root(spark)}/llm-{spark.sparkContext.applicationId}"


def remove_run(spark: SparkSession) -> None:
    """Remove what this application has written in between. Results that have not been read or stored yet depend on it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the run's folder and read again: lineage is cut, files are shared."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._llm_path = path
    return table


def drop_shared(table: DataFrame) -> None:
    """Remove the files of a :func:`shared_table` that nobody reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._llm_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.view(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [x or b"" for x in column.to_pylist()]


def slices(batch: pa.RecordBatch, rows: int = 256, size: int = 4 << 20):
    """Short runs of a batch, of so many rows and bytes of text at most (or one row), so that long texts are held a few at a time."""
    sizes = np.zeros(batch.num_rows + 1, np.int64)
    for column in batch.columns:
        kind = column.type
        if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
            sizes[1:] += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        end = int(np.searchsorted(ends, ends[at] + size, "right")) - 1
        end = max(at + 1, min(end, at + rows))
        yield batch.slice(at, end - at)
        at = end


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all elements of ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class Numbered(dict):
    """Numbers of keys in the order in which they are met; ``new`` collects those met since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = place = len(self)
        self.new.append(key)
        return place

    def of(self, keys: Sequence) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class IdRuns:
    """Runs of ids, one after the other in one growing array."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.n = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of further runs, of which each has so many."""
        at = int(self.ends[self.n - 1]) if self.n else 0
        while self.n + len(sizes) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[at:at + len(ids)] = ids
        self.ends[self.n:self.n + len(sizes)] = np.cumsum(sizes) + at
        self.n += len(sizes)

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs in a row, and how many each has."""
        starts = np.where(places > 0, self.ends[places - 1], 0)
        lengths = self.ends[places] - starts
        return self.ids[ragged(starts, lengths)], lengths


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node over edges (a, b).

    Alternating large-star and small-star steps until nothing changes. Each step is a grouping with a
    combinable minimum and a join that can be split where a node is hot; lineage is cut in each round.
    Nodes without an edge to another node are left out.
    """
    def stars(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        across = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return across.union(down.select("a", F.col("m").alias("b"))).distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = shared_table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = state(current)
    while before[0]:
        following = shared_table(stars(current), "edges")
        drop_shared(current)
        current, after = following, state(following)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def span_text(spans) -> F.Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
