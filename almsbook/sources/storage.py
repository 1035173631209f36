"""Shared scratch space for intermediate tables."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None
_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside once the block is left. What was written elsewhere stays."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds, if it is there."""
    place, system = _place(spark, path)
    system.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if there is no such place."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place) if status.isDirectory())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below a checkpoint folder set by the caller.

    Every executor has to reach it, so a machine-local folder is only made up for a local master.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="almsbook-")
        base = _local_base
    path = f"{base.rstrip('/')}/{name}-{uuid4().hex}"
    for made in _scopes:
        made.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch space and return a scan of what was written.

    The written rows are fixed: a lost executor costs a re-read, never a different answer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
