"""Where intermediate tables go.

A cluster names a shared folder in ``spark.checkpoint.dir``. Only a session whose
tasks all run in the driver's process (``local``, not ``local-cluster``) may do
without and gets a temporary folder of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Shuffle files go when the query that wrote them ends; a staged table is all that later queries read.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set up on first use."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="paperloom-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


def materialized(df: DataFrame, label: str = "table", compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back.

    The rows are computed once, a lost executor cannot change them, and later readers
    get only the columns they ask for. Shuffle files of the computation are not kept.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, lazy plans included. Others are left alone."""
    for table in tables:
        path = table.__dict__.get("_staged")
        if path:
            _delete(table.sparkSession, path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, so results must have been written elsewhere by then."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
