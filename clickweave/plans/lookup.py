"""Keyed lookups whose join strategy follows the measured size of the table.

Small table: one broadcast join, no shuffle of the rows.  Large table: a
shuffled join whose key is extended by a salt.  Keys that would be a large part
of one task's rows are hot: their rows draw a salt from their own id, and the
table has a copy of such a key for every salt.  Rows without a key are spread
the same way.  Hot keys are told by a 64-bit hash, so their length does not
matter; a key that only shares the hash is salted too and loses nothing.  Every
path returns exactly the rows of a plain left / anti join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.plans.scratch import materialize

BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD_BYTES = 64
# a key is hot if its rows are more than this share of the mean rows of a reduce task
HOT_SHARE = 0.5
SALTS_PER_TASK = 4


def table_bytes(rows: Column, text: Column | None = None, row_bytes: int = ROW_OVERHEAD_BYTES) -> Column:
    """Aggregate: memory a lookup table takes, from its rows and the bytes of its text."""
    fixed = F.count(rows) * F.lit(row_bytes)
    return fixed if text is None else fixed + F.coalesce(F.sum(F.octet_length(text).cast("bigint")), F.lit(0))


def fits(table: DataFrame, limit: int, row_bytes: int = ROW_OVERHEAD_BYTES) -> bool:
    """Measure a table of plain numbers against a broadcast limit (one small job)."""
    return table.agg(table_bytes(F.lit(1), row_bytes=row_bytes).alias("bytes")).first()["bytes"] <= limit


def reduce_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _keyless(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes of the keys that need a salt, as a written table of at most 2 x reduce tasks rows.

    The rows are read once: their number is the sum of the counts, which the
    planner takes from the same exchange.
    """
    keyed = rows.where(~_keyless(keys)).select(F.xxhash64(*keys).alias("_hash"))
    counts = keyed.groupBy("_hash").agg(F.count("*").alias("n"))
    limit = counts.agg((F.sum("n") * F.lit(HOT_SHARE / reduce_tasks(rows.sparkSession))).alias("limit")).scalar()
    return materialize(counts.where(F.col("n") > limit).select("_hash"), "hot-keys")


def _marked(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    flagged = hot.select("_hash", F.lit(True).alias("_hot"))
    return df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(flagged), "_hash", "left")


def _salts(spark: SparkSession) -> int:
    return SALTS_PER_TASK * reduce_tasks(spark)


def salted_rows(rows: DataFrame, keys: Sequence[str], hot: DataFrame, spread: str) -> DataFrame:
    """Add ``_salt``: a class of ``spread`` for rows with a hot key or none, else 0."""
    loose = F.coalesce("_hot", F.lit(False)) | _keyless(keys)
    salt = F.when(loose, F.pmod(F.xxhash64(spread), F.lit(_salts(rows.sparkSession)))).otherwise(F.lit(0))
    return _marked(rows, keys, hot).select(*rows.columns, salt.cast("bigint").alias("_salt"))


def salted_table(table: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """The table with a row for every ``_salt`` that rows of its key can have."""
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(_salts(table.sparkSession) - 1).cast("bigint"))
    salts = F.when(F.coalesce("_hot", F.lit(False)), every).otherwise(F.array(F.lit(0).cast("bigint")))
    return _marked(table, keys, hot).select(*table.columns, F.explode(salts).alias("_salt"))


def left_lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    take: Sequence[str],
    *,
    small: bool,
    hot: DataFrame | None = None,
    spread: str = "obs_id",
) -> DataFrame:
    """``rows`` left join ``table`` on ``keys``; the columns ``take`` are NULL on a miss.

    ``table`` is unique on ``keys`` and has no NULL in them.  ``spread`` is a
    column of the rows that differs among rows of one key.
    """
    keys, take = list(keys), list(take)
    table = table.select(*keys, *take)
    if small:
        return rows.join(F.broadcast(table), keys, "left")
    if hot is None:
        raise ValueError("a table too large to broadcast needs its hot keys")
    joined = salted_rows(rows, keys, hot, spread).join(salted_table(table, keys, hot), [*keys, "_salt"], "left")
    return joined.select(*rows.columns, *take)


def anti_lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], *, small: bool, hot: DataFrame | None = None
) -> DataFrame:
    """Rows of ``rows`` whose key is not in ``table``."""
    keys = list(keys)
    if small:
        return rows.join(F.broadcast(table.select(*keys)), keys, "left_anti")
    flagged = table.withColumn("_known", F.lit(True))
    found = left_lookup(rows, flagged, keys, ["_known"], small=False, hot=hot)
    return found.where(F.col("_known").isNull()).drop("_known")
