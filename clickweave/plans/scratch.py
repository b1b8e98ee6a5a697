"""Durable hand-over points between jobs.

A fitted artefact (dictionary, rank, weight table) is written once to the
shared folder of the session and read back, so it survives lost executors, has
true file statistics and starts a fresh plan.  The folder is the one named in
``spark.checkpoint.dir``, else the one given to ``setCheckpointDir``.  A folder
of our own is made only in local mode, where driver and executors are one
process; anywhere else its absence is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_own_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session; a folder of our own only in local mode without one."""
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError(
            f"no shared folder: set {_CHECKPOINT_CONF} (or call setCheckpointDir) to one that all executors see"
        )
    app = context.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="clickweave-")
    return _own_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/clickweave/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table and return a plain scan of it."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a folder."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`materialize` that nothing reads any more."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
