"""Session settings and the folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where a grouping on the join key follows it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "mostrador", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators expect; ``extra`` uses ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


#: Shuffle files of a job that writes an intermediate table are of no use after it.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors share.

    ``spark.checkpoint.dir``, else the folder given to ``SparkContext.setCheckpointDir``; without either there is
    none, and the call fails.
    """
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen
    raise RuntimeError("set spark.checkpoint.dir, or call SparkContext.setCheckpointDir, with a folder that all executors share")


def prepare(spark: SparkSession) -> SparkSession:
    """For local runs, such as tests: a temporary checkpoint folder where the session names none."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return spark
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mostrador-"))
    return spark


_written: ContextVar[list | None] = ContextVar("written", default=None)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table once and go on from its files.

    Later jobs read the files instead of the facts, survive a lost executor, and give the
    optimiser exact sizes for its broadcast decision.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/mostrador/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    if (written := _written.get()) is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables, wherever they are stored."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the tables that are settled within, at the end; results have to be read or written before.

        with intermediate(spark):
            negative_margin(model).write.parquet(target)
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)
        delete(spark, *paths)
