"""Session defaults and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wattledger")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster in `spark.checkpoint.dir`.

    Only a local session, which has one machine, may go without: it gets a new folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wattledger-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


#: Lists that take note of staged tables, innermost last.
_records: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Paths of the tables staged within the block, for `discard` once nothing reads them any more."""
    paths: list[str] = []
    _records.append(paths)
    try:
        yield paths
    finally:
        _records[:] = [r for r in _records if r is not paths]


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    if not exists(spark, folder):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return [status.getPath().getName() for status in found]


def first_time(spark: SparkSession, folder: str) -> datetime:
    """The time at which this was first called for the folder, which keeps it."""
    if not exists(spark, f"{folder}/_SUCCESS"):
        now = spark.sql("select current_timestamp() as t")
        now.coalesce(1).write.mode("overwrite").parquet(folder)
    return spark.read.schema("t timestamp").parquet(folder).first()["t"]


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged tables, through the file system that holds them. Tables already gone are fine."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_AQE_EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
_EMPTY_STAGES = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


@contextmanager
def keeping_empty_stages(spark: SparkSession) -> Iterator[None]:
    """Keep stages without rows in the plans that run within the block; otherwise what they have observed is lost."""
    before = spark.conf.get(_AQE_EXCLUDED, None)
    spark.conf.set(_AQE_EXCLUDED, ",".join(filter(None, [before, _EMPTY_STAGES])))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_AQE_EXCLUDED)
        else:
            spark.conf.set(_AQE_EXCLUDED, before)


def new_folder(spark: SparkSession) -> str:
    """Name of a new folder in the shared folder; `recorded` takes note of it."""
    folder = f"{shared_folder(spark)}/wattledger/{uuid.uuid4().hex}"
    for record in _records:
        record.append(folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a parquet table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, keeps column pruning for
    the readers, and lets several outputs share one computation. Whoever runs the block
    around it (`recorded`) discards the table; otherwise it stays in the shared folder.
    """
    spark = df.sparkSession
    folder = new_folder(spark)
    df.write.parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")
