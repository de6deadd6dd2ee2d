"""Shared storage for tables that a job writes and reads again.

Executors can be lost at any time, so lineage is cut only by tables in the folder that the
cluster names in ``spark.checkpoint.dir``; a folder of our own is used only where that is unset
and all tasks run on this machine.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Open scopes by thread, innermost last.
_scopes: dict[int, list[list[str]]] = {}


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that the driver and all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/brandtide-shared"
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/brandtide-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd").option("parquet.block.size", str(16 << 20))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    for scope in _scopes.get(threading.get_ident(), [])[-1:]:
        scope.append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    _delete(df.sparkSession, df._staged_at)
    for scope in _scopes.get(threading.get_ident(), []):
        if df._staged_at in scope:
            scope.remove(df._staged_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged within are deleted at the end, save those given to the function that this yields.

    Give it every staged table that a result still reads; it returns them. They pass to the scope around, if any.
    """
    scopes = _scopes.setdefault(threading.get_ident(), [])
    own: list[str] = []
    kept: list[str] = []
    scopes.append(own)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df._staged_at)
        return df

    try:
        yield keep
    finally:
        scopes.pop()
        for path in own:
            if path not in kept:
                _delete(spark, path)
        if scopes:
            scopes[-1].extend(kept)
        else:
            del _scopes[threading.get_ident()]
