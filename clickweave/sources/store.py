"""Encoded observations as a stored table: written once, read by split, joined without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.plans.scratch import scratch_path

BUCKETS = 32
_SPLIT, _KEY = "split", "obs_id"


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def write_encoded(encoded: DataFrame, path: str | None = None, *, table: str | None = None, buckets: int = BUCKETS) -> str:
    """Write ``encoded``, partitioned by split and bucketed by observation id; returns the table's name.

    Rows are shuffled once, to the bucket of their id, so there is one file per
    bucket and split however many tasks the encoding had.  Inside a file the rows
    are sorted by id.  ``path`` is a folder that all executors see, by default
    a new one in the shared folder of the session; ``table`` must not exist.
    """
    spark = encoded.sparkSession
    missing = {_SPLIT, _KEY} - set(encoded.columns)
    if missing:
        raise ValueError(f"encoded rows need the columns {sorted(missing)}")
    path = path or scratch_path(spark, "encoded")
    table = table or f"encoded_{uuid.uuid4().hex}"
    # the exchange deals by the same hash as the buckets
    dealt = encoded.repartition(buckets, _KEY)
    writer = dealt.write.format("parquet").option("path", path)
    writer.partitionBy(_SPLIT).bucketBy(buckets, _KEY).sortBy(_KEY).saveAsTable(_quoted(table))
    return table


def open_encoded(
    spark: SparkSession, path: str, schema: str, *, table: str | None = None, buckets: int = BUCKETS
) -> str:
    """Make a folder that :func:`write_encoded` wrote known to this session; returns the table's name.

    ``schema`` is the DDL of the written columns.  ``buckets`` must be the
    number it was written with, as Spark takes it on trust.
    """
    table = table or f"encoded_{uuid.uuid4().hex}"
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {_quoted(table)} ({schema}) USING parquet PARTITIONED BY ({_SPLIT}) "
        f"CLUSTERED BY ({_KEY}) SORTED BY ({_KEY}) INTO {int(buckets)} BUCKETS LOCATION '{location}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {_quoted(table)}")
    return table


def read_encoded(spark: SparkSession, table: str, split: str | None = None) -> DataFrame:
    """Stored rows, all of them or those of one split: then only its folder is read."""
    rows = spark.table(_quoted(table))
    return rows if split is None else rows.where(F.col(_SPLIT) == split)


def drop_encoded(spark: SparkSession, table: str) -> None:
    """Forget the table; its files stay with whoever owns the folder."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
