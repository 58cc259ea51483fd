"""Make the package importable in Python workers, wherever the session was started."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors once per application (``addPyFile``).

    The driver serves the archive to executors that start later too, so it stays until
    the driver ends.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="basketlens-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker outlives its task and is used again."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _released(function: Callable) -> Callable:
    def run(batches):
        try:
            yield from function(batches)
        finally:
            release_memory()

    return run


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped first; a task leaves no freed memory in its worker."""
    ship(df.sparkSession)
    return df.mapInArrow(_released(function), schema)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most so many rows at a time to Python in what is written inside: for wide rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Bytes handed to Python at a time where rows hold whole texts.
BATCH_BYTES = 4 << 20


@contextmanager
def batch_bytes(spark: SparkSession) -> Iterator[None]:
    """Hand few bytes at a time to Python in what is written inside; both sides hold whole batches outside the heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)
