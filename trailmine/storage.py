"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, which all executors must reach.

    Only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trailmine-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that no frame reads any more."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at the end.

    Write results before the scope is left: frames that read its tables no longer work
    afterwards. Jobs in several threads of a driver have scopes of their own.
    """
    path = f"{scratch_root(spark)}/scope-{uuid.uuid4().hex}"
    before = _SCOPE.set(path)
    try:
        yield
    finally:
        _SCOPE.reset(before)
        remove_path(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the innermost scope, or else below :func:`scratch_root`."""
    return f"{_SCOPE.get() or scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy survives lost executors, is read by column, gives several consumers
    one evaluation, and tells the optimizer its real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_together(frames: Mapping[str, DataFrame]) -> list[DataFrame]:
    """:func:`materialise` for independent frames, as jobs side by side in the scope of the caller."""
    with ThreadPoolExecutor(len(frames)) as pool:
        jobs = [pool.submit(copy_context().run, materialise, df, label) for label, df in frames.items()]
        return [job.result() for job in jobs]
