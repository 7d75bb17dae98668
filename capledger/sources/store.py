"""Stored tables that change in versions: one manifest names the folders of all tables.

A commit writes new Parquet folders and then puts the next manifest in place by a rename that fails if it is
there already. Readers take the newest manifest, so they see all folders of a commit or none; a writer that
breaks before the rename leaves folders nobody reads, and of two writers from the same version one is told to
start again.

Changes of rows are kept beside the rows they change: a change is a folder of whole rows, or of marks that a key
is gone, and only touched rows are written. Reading hides base rows by an anti-join with the keys of the changes,
which are few until ``compact`` folds them in; where they are many, they are not broadcast. Tables can be stored by buckets of a column; reading some
buckets prunes all other files. Writes are numbered in their order, also those of one commit: of several changes
of a key the last one counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from capledger.schema import TABLES
from capledger.session import sized

BUCKET, COMMIT, GONE = "_bucket", "_commit", "_gone"
DRAFTS = "_drafts"

#: Writes of one commit have numbers of their own, from this many times its version on.
WRITES_PER_COMMIT = 1 << 20


@dataclass(frozen=True)
class Layout:
    """Schema and key of a table, and the column and number of its buckets."""

    schema: str
    key: tuple[str, ...]
    bucket_by: str | None = None
    buckets: int = 16

    def types(self) -> dict[str, str]:
        """Column names with their types."""
        return dict(f.strip().split(" ", 1) for f in self.schema.replace("\n", " ").split(", "))

    def columns(self) -> list[str]:
        return list(self.types())

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.bucket_by), F.lit(self.buckets)).cast("int") if self.bucket_by else F.lit(0)


LAYOUTS = {
    "companies": Layout(TABLES["companies"], ("id",)),
    "funding_rounds": Layout(TABLES["funding_rounds"], ("id",), "company_id"),
    "investors": Layout(TABLES["investors"], ("id",)),
    "round_investors": Layout(TABLES["round_investors"], ("round_id", "investor_id")),
    "sources": Layout(TABLES["sources"], ("id",)),
    "processing_status": Layout(TABLES["processing_status"], ("company_id",)),
    "llm_usage": Layout(TABLES["llm_usage"], ("provider_name", "model_name", "date")),
}


class Conflict(RuntimeError):
    """Another writer has committed since the version that a transaction started from."""


@dataclass(frozen=True)
class Manifest:
    """What a version holds: folders of rows and of changes for each table, with the number of the write each came with."""

    version: int = 0
    rows: dict[str, list[tuple[str, int]]] = field(default_factory=dict)
    changes: dict[str, list[tuple[str, int]]] = field(default_factory=dict)
    #: The last number that each source of numbered commits has committed.
    done: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"version": self.version, "rows": self.rows, "changes": self.changes, "done": self.done})

    @staticmethod
    def parse(text: str) -> Manifest:
        read = json.loads(text)
        folders = [{t: [(f, v) for f, v in own] for t, own in read[kind].items()} for kind in ("rows", "changes")]
        return Manifest(read["version"], *folders, read["done"])

    def folders(self) -> set[str]:
        return {f for kind in (self.rows, self.changes) for own in kind.values() for f, _ in own}


class Store:
    """Versioned tables below one folder of a shared file system whose rename is atomic."""

    def __init__(self, spark: SparkSession, root: str, layouts: dict[str, Layout] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.layouts = LAYOUTS if layouts is None else layouts
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._files = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = hadoop.FileContext.getFileContext(self._files.getUri(), spark._jsc.hadoopConfiguration())
        self._counts: dict[str, int] = {}  # rows of folders, which never change

    # -------------------------------------------------------------- versions

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_manifests")
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest version, or an earlier one that is still kept."""
        versions = self._versions()
        if version is None and not versions:
            return Manifest()
        if version is not None and version not in versions:
            raise KeyError(f"version {version} is not kept")
        with_text = self._files.open(self._path(f"{self.root}/_manifests/{versions[-1] if version is None else version:020d}.json"))
        try:
            return Manifest.parse(bytes(with_text.readAllBytes()).decode())
        finally:
            with_text.close()

    def publish(self, manifest: Manifest) -> None:
        """Make a version the newest one; it must not exist."""
        name = f"{self.root}/_manifests/{manifest.version:020d}.json"
        draft = self._path(f"{self.root}/_manifests/.{uuid.uuid4().hex}.draft")
        out = self._files.create(draft, False)
        out.write(manifest.text().encode())
        out.close()
        none = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        try:
            self._context.rename(draft, self._path(name), options)
        except Exception as error:
            self._files.delete(draft, False)
            if manifest.version in self._versions():
                raise Conflict(f"version {manifest.version} has been committed by another writer") from error
            raise

    # -------------------------------------------------------------- reading

    def read(self, name: str, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a table in a version, of all buckets or of some."""
        return self._read(self.manifest(version), name, buckets)

    def _read(self, manifest: Manifest, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        layout = self.layouts[name]
        columns, wanted = layout.columns(), None if buckets is None else sorted(set(buckets))
        rows = self._folders(name, manifest.rows.get(name, []), layout.schema, wanted)
        if not manifest.changes.get(name):
            return rows.select(columns)
        changes = self._folders(name, manifest.changes[name], f"{layout.schema}, {GONE} BOOLEAN", wanted)
        rest = [c for c in changes.columns if c not in layout.key and c != COMMIT]
        # Of several changes of a key the newest counts. One write changes a key once.
        newest = changes.groupBy(*layout.key).agg(F.max(COMMIT).alias(COMMIT), F.max_by(F.struct(*rest), COMMIT).alias("_row"))
        hiding = newest.select(*[F.col(k).alias(f"_{k}") for k in layout.key], F.col(COMMIT).alias("_since"))
        hiding = sized(hiding, self.count(name, manifest.changes[name]))
        condition = (F.col("_since") >= F.col(COMMIT))
        for k in layout.key:
            condition &= F.col(k) == F.col(f"_{k}")
        kept = rows.join(hiding, condition, "left_anti")
        later = rows.select(*[F.col(k).alias(f"_{k}") for k in layout.key], F.col(COMMIT).alias("_again"))
        # A key that was added again after its last change is read from there.
        again = F.col("_again") > F.col(COMMIT)
        for k in layout.key:
            again &= F.col(k) == F.col(f"_{k}")
        changed = newest.where(~F.col(f"_row.{GONE}"))
        first = min(v for _, v in manifest.changes[name])
        added = [(f, v) for f, v in manifest.rows.get(name, []) if v > first]
        if added:
            changed = changed.join(sized(later.where(F.col("_again") > first), self.count(name, added)), again, "left_anti")
        return kept.select(columns).unionByName(changed.select(*layout.key, "_row.*").select(columns))

    def _folders(self, name: str, folders: list[tuple[str, int]], schema: str, buckets: list[int] | None) -> DataFrame:
        """All rows of folders, each with the number of the write its folder came with."""
        full = f"{schema}, {BUCKET} INT"
        if not folders:
            return self.spark.createDataFrame([], f"{full}, {COMMIT} BIGINT")
        # One scan for all folders; buckets are partitions below each, the write's number is a column of their files.
        table = f"{self.root}/{name}"
        found = self.spark.read.schema(f"{full}, {COMMIT} BIGINT").option("basePath", table).parquet(*[f"{table}/{f}" for f, _ in folders])
        return found if buckets is None else found.where(F.col(BUCKET).isin(buckets))

    def count(self, name: str, folders: list[tuple[str, int]]) -> int:
        """Rows in folders of a table; each folder is counted once."""
        for folder, _ in folders:
            if folder not in self._counts:
                self._counts[folder] = self.spark.read.schema(f"{COMMIT} BIGINT").parquet(f"{self.root}/{name}/{folder}").count()
        return sum(self._counts[f] for f, _ in folders)

    def count_at_most(self, name: str) -> int:
        """At least as many as the newest version of a table has rows."""
        return self._count_at_most(self.manifest(), name)

    def _count_at_most(self, manifest: Manifest, name: str) -> int:
        return self.count(name, manifest.rows.get(name, []) + manifest.changes.get(name, []))

    def buckets_of(self, name: str, rows: DataFrame) -> list[int]:
        """The buckets that rows belong to: at most as many numbers as the table has buckets."""
        return [r[0] for r in rows.select(self.layouts[name].bucket()).distinct().collect()]

    # -------------------------------------------------------------- writing

    @contextmanager
    def transaction(self, source: str | None = None, number: int | None = None) -> Iterator[Transaction]:
        """Collect writes and commit them together at the end; an exception commits nothing.

        A numbered commit of a source is made once: check ``transaction.repeated`` when a stream may deliver again.
        """
        own = Transaction(self, self.manifest(), source, number)
        try:
            yield own
            own.commit()
        finally:
            own.discard()

    def compact(self, name: str) -> None:
        """Fold the changes of a table into one new folder of rows."""
        with self.transaction() as own:
            own.replace(name, own.read(name))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last versions, folders that none of them names and drafts; writers must be at rest."""
        self._files.delete(self._path(f"{self.root}/{DRAFTS}"), True)
        versions = self._versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        named = {(t, f) for m in kept for kind in (m.rows, m.changes) for t, own in kind.items() for f, _ in own}
        for version in versions[:-keep]:
            self._files.delete(self._path(f"{self.root}/_manifests/{version:020d}.json"), False)
        removed = []
        for name in self.layouts:
            folder = self._path(f"{self.root}/{name}")
            for status in self._files.listStatus(folder) if self._files.exists(folder) else ():
                if (name, status.getPath().getName()) not in named and status.isDirectory():
                    self._files.delete(status.getPath(), True)
                    removed.append(f"{name}/{status.getPath().getName()}")
        return removed


class Transaction:
    """Writes that become visible together."""

    def __init__(self, store: Store, start: Manifest, source: str | None, number: int | None):
        self.store, self.start = store, start
        self.source, self.number = source, number
        self.rows = {t: list(f) for t, f in start.rows.items()}
        self.changes = {t: list(f) for t, f in start.changes.items()}
        self.writes = 0
        self.drafts: list[str] = []

    @property
    def repeated(self) -> bool:
        """Whether this source has committed this number before."""
        return self.source is not None and self.start.done.get(self.source, -1) >= self.number

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table as this transaction leaves it so far."""
        return self.store._read(Manifest(self.start.version, self.rows, self.changes), name, buckets)

    def count_at_most(self, name: str) -> int:
        """At least as many as the table has rows, as this transaction leaves it so far."""
        return self.store._count_at_most(Manifest(self.start.version, self.rows, self.changes), name)

    def keep(self, rows: DataFrame) -> DataFrame:
        """``rows`` evaluated once, for several writes of this transaction; later steps read only the columns they need.

        They lie beside the tables and are gone when the transaction ends, whether it commits or not.
        """
        draft = f"{self.store.root}/{DRAFTS}/{uuid.uuid4().hex}"
        self.drafts.append(draft)
        rows.write.parquet(draft)
        return self.store.spark.read.schema(rows.schema).parquet(draft)

    def discard(self) -> None:
        """Remove what was kept."""
        for draft in self.drafts:
            self.store._files.delete(self.store._path(draft), True)
        self.drafts = []

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows whose keys are new."""
        self._add(self.rows, name, rows.select(self.store.layouts[name].columns()))

    def added(self, name: str) -> DataFrame:
        """What the last ``append`` to a table has written."""
        return self.store._read(Manifest(self.start.version, {name: self.rows[name][-1:]}), name)

    def change(self, name: str, rows: DataFrame) -> None:
        """Put whole rows in place of those with the same keys; each key once. Later writes of a transaction win."""
        self._add(self.changes, name, rows.select(*self.store.layouts[name].columns(), F.lit(False).alias(GONE)))

    def remove(self, name: str, keys: DataFrame) -> None:
        """Mark keys as gone. Tables by buckets need the bucket column beside the key."""
        held = [F.col(c) if c in keys.columns else F.lit(None).alias(c) for c in self.store.layouts[name].columns()]
        self._add(self.changes, name, keys.select(*held, F.lit(True).alias(GONE)))

    def replace(self, name: str, rows: DataFrame) -> None:
        """Put rows in place of the whole table."""
        folder = self._write(name, rows.select(self.store.layouts[name].columns()))
        self.rows[name], self.changes[name] = [folder], []

    def _add(self, kind: dict[str, list[tuple[str, int]]], name: str, rows: DataFrame) -> None:
        kind[name] = [*kind.get(name, []), self._write(name, rows)]

    def _write(self, name: str, rows: DataFrame) -> tuple[str, int]:
        layout, number = self.store.layouts[name], (self.start.version + 1) * WRITES_PER_COMMIT + self.writes
        folder = f"part={uuid.uuid4().hex}"
        # Rows of a bucket are brought together; large buckets are split over several tasks.
        typed = rows.withColumns({c: F.col(c).cast(t) for c, t in layout.types().items()})
        placed = typed.withColumn(BUCKET, layout.bucket()).withColumn(COMMIT, F.lit(number).cast("bigint"))
        if layout.bucket_by:
            placed = placed.hint("rebalance", BUCKET)
        placed.write.partitionBy(BUCKET).parquet(f"{self.store.root}/{name}/{folder}")
        self.writes += 1
        return folder, number

    def commit(self) -> None:
        if self.writes or self.source is not None and not self.repeated:
            done = dict(self.start.done)
            if self.source is not None:
                done[self.source] = self.number
            self.store.publish(Manifest(self.start.version + 1, self.rows, self.changes, done))
