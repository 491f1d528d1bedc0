"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables that the innermost contained function has stored so far.
_within: ContextVar[list[str] | None] = ContextVar("_within", default=None)


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="costlake-shared-")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster names it; where unset in local mode (tests) a temporary folder takes its place."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = _local_folder(spark.sparkContext.applicationId)
    return named.rstrip("/")


def materialize(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    It cuts the lineage, and what was computed outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/costlake/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if by:
        writer = writer.partitionBy(*by)
    if (stored := _within.get()) is not None:
        stored.append(path)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def contained(name: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Decorator: what the function returns is stored under name, then the tables that it stored on the way are removed."""

    def wrap(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(work)
        def run(*args, **named) -> DataFrame:
            stored: list[str] = []
            outer = _within.get()
            token = _within.set(stored)
            try:
                found = work(*args, **named)
                _within.set(outer)
                return materialize(found, name)
            finally:
                _within.reset(token)
                _remove(stored)

        return run

    return wrap


def _remove(paths: list[str]) -> None:
    spark = SparkSession.active()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
