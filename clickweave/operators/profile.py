"""Counts over features, encoded rows and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.scalar import OVERFLOW_BUCKET, pow2_bucket


def categories_per_feature(features: DataFrame) -> DataFrame:
    """Distinct values of each feature, in feature order."""
    return features.groupBy("feature_id").agg(F.countDistinct("value").alias("n_categories")).orderBy("feature_id")


def explode_encoded(encoded: DataFrame) -> DataFrame:
    """One row per non-zero: ``idx`` and ``val``.

    Outer explode and filter, so that no size test repeats the encoding.
    """
    return explode_encoded_outer(encoded).where(F.col("idx").isNotNull())


def explode_encoded_outer(encoded: DataFrame) -> DataFrame:
    """As :func:`explode_encoded`, with one NULL entry for a row without non-zeros."""
    carried = [c for c in encoded.columns if c not in ("indices", "values")]
    pairs = F.arrays_zip(F.col("indices").alias("idx"), F.col("values").alias("val"))
    return encoded.select(*carried, F.inline_outer(pairs).alias("idx", "val"))


def nnz() -> Column:
    return F.size("indices")


def nnz_per_row(encoded: DataFrame) -> DataFrame:
    return encoded.select("obs_id", nnz().alias("nnz"))


def total_nnz(encoded: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Non-zeros of all rows, overall or per group."""
    return encoded.groupBy(*by).agg(F.coalesce(F.sum(nnz().cast("bigint")), F.lit(0)).alias("total_nnz"))


def sparsity(encoded: DataFrame, dimension: int | Column) -> DataFrame:
    """Average share of non-zero dimensions per row."""
    size = F.lit(dimension) if isinstance(dimension, int) else dimension
    return encoded.agg(F.avg(nnz()).alias("mean_nnz")).select((F.col("mean_nnz") / size).alias("sparsity"))


def first_k_sum(df: DataFrame, amount: Column, k: int, by: str = "obs_id", name: str = "total") -> DataFrame:
    """Sum of ``amount`` over the first ``k`` rows in key order."""
    return df.select(by, amount.alias(name)).orderBy(by).limit(k).agg(F.sum(name).alias(name))


def feature_frequency(encoded: DataFrame) -> DataFrame:
    """Rows in which each index occurs."""
    single = encoded.select(F.explode_outer("indices").alias("idx")).where(F.col("idx").isNotNull())
    return single.groupBy("idx").agg(F.count("*").alias("n"))


def frequency_histogram(frequency: DataFrame) -> DataFrame:
    """Indices per power-of-two frequency bucket; frequencies above 1024 are left out."""
    return (
        frequency.select(pow2_bucket(F.col("n")).cast("bigint").alias("bucket"))
        .where(F.col("bucket") != OVERFLOW_BUCKET)
        .groupBy("bucket")
        .agg(F.count("*").alias("n_features"))
    )


def frequency_histogram_log(histogram: DataFrame) -> DataFrame:
    """The histogram with the natural logs of both columns."""
    return histogram.select(
        "bucket", "n_features", F.ln("bucket").alias("ln_bucket"), F.ln("n_features").alias("ln_features")
    )


def class_rate(labelled: DataFrame) -> DataFrame:
    """Mean label."""
    return labelled.agg(F.avg("label").alias("class_rate"))
