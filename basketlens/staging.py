"""Written intermediate tables in the shared folder of the session.

Operators that read the same rows more than once (quantile narrowing, neighbour
search, model fitting) write them to parquet first: later passes prune columns at
the scan, and a lost executor costs a re-read instead of the whole lineage.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the warehouse.

    Both are shared by the driver and the executors of a cluster; the master plays no part.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.staged"
    return named.rstrip("/")


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative ML fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))


_folders: set[str] = set()


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the application's folder, which goes when the driver ends."""
    folder = f"{checkpoint_root(spark)}/basketlens/{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_clear, spark._jvm, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def _clear(jvm, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        target = jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)


def stage_path(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """Write ``df`` once; the written table and its folder."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return the written table."""
    return stage_path(df, name, partition_by)[0]


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside removes its shuffle files when it is done: nothing reads them after a staged table."""
    with _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


#: Bytes of compressed input that a task of a wide aggregation reads.
TASK_BYTES = 16 << 20


@contextlib.contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """What is written inside reads little at a time: groups that are as many as the rows stay in a task's memory."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    with _settings(spark, dict.fromkeys(keys, str(TASK_BYTES))):
        yield


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that no result reads any more."""
    root = f"{checkpoint_root(spark)}/basketlens/"
    for path in paths:
        if not path.startswith(root):
            raise ValueError(f"{path} is not a staged table of this session")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
