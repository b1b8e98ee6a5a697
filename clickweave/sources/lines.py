"""Reading, normalising and checking delimited text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.plans.scratch import discard, folder_bytes, materialize, scratch_path

# a staged file can be cut where a row group of this many bytes ends
BLOCK_BYTES = 32 << 20


def load_lines(
    spark: SparkSession,
    path: str,
    stage: bool = True,
    stage_path: str | None = None,
    *,
    min_partitions: int = 1,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Text file(s), plain or compressed, as ``(obs_id, line)``.

    Text rows are anonymous, so they get an id.  The id depends on how the
    files were split, hence by default the lines are staged once as Parquet:
    ids stay fixed for good, and later jobs read splittable columnar data even
    when the input was one gzip stream.  Its row groups are bounded by
    ``block_bytes``, so readers share a long stream among as many tasks as
    their own split size allows, without a shuffle.  What is too small for
    ``min_partitions`` such blocks is dealt out once more, evenly; that many
    partitions are read then at least.
    """
    lines = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("obs_id"), F.col("value").alias("line")
    )
    if not stage:
        return lines
    first = stage_path if min_partitions <= 1 and stage_path else scratch_path(spark, "lines")
    # ids are fixed here
    lines.write.option("parquet.block.size", block_bytes).parquet(first)
    staged = spark.read.schema(lines.schema).parquet(first)
    if min_partitions <= 1 or folder_bytes(spark, first) >= 2 * min_partitions * block_bytes:
        return staged
    dealt = materialize(staged.repartition(min_partitions), "lines", stage_path)
    discard(spark, first)
    if dealt.rdd.getNumPartitions() >= min_partitions:
        return dealt
    # small files may share a task
    return dealt.repartition(min_partitions)


def normalize_lines(lines: DataFrame) -> DataFrame:
    """Every tab becomes a comma, so either delimiter works."""
    return lines.withColumn("line", F.replace("line", F.lit("\t"), F.lit(",")))


def preview(df: DataFrame, k: int, by: str = "obs_id") -> DataFrame:
    """First ``k`` rows in key order (a distributed top-k, not a global sort)."""
    return df.orderBy(by).limit(k)


def row_count_check(df: DataFrame, expected: int) -> DataFrame:
    """One row ``(actual, expected, ok)``."""
    target = F.lit(expected).cast("bigint")
    return df.agg(F.count("*").alias("actual")).select(
        "actual", target.alias("expected"), (F.col("actual") == target).alias("ok")
    )
