"""Session construction and reliable materialisation."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: What one task of a join or an aggregation that ``spread`` prepares holds, about.
ROWS_PER_TASK = 500_000

#: Rows of a table that Spark may broadcast on the ground of its files, see ``sized``.
BROADCAST_ROWS = 100_000


def build_session(app_name: str = "capledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; keyword overrides use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Checkpoints nobody refers to any more are removed.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Building a wide plan from Python is several times faster without call-site capture.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session that names none
    gets a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    scratch = tempfile.mkdtemp(prefix="capledger-checkpoint-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return it with its lineage cut."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, file_rows: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` written once as Parquet beside the checkpoints, in files of at most so many rows, which are read by several tasks.

    For tables of many narrow rows: a checkpoint of them is several times as large. The files go when the session's
    JVM ends.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_root(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", max(1, file_rows)).parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *keys: str, like: DataFrame | None = None) -> DataFrame:
    """``df`` by ``keys`` over as many tasks as its rows ask for, so that a task's memory does not grow with the table.

    ``like`` is a table of about as many rows that is cheaper to count. Where the session's number of tasks is
    enough, the shuffles are left to Spark.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = math.ceil((df if like is None else like).count() / ROWS_PER_TASK)
    return df.repartition(tasks, *keys) if tasks > usual else df


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as the side of a join that is broadcast only if it has few rows.

    Spark judges a table by its files. Ids in order and columns of one value take next to nothing there, but a broadcast
    of them is built row by row in the driver's memory. ``rows`` is their number or a larger one, if known.
    """
    return df.hint("merge") if (df.count() if rows is None else rows) > BROADCAST_ROWS else df
