"""Feature hashing: row-local, so no dictionary and no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.hashing import feature_string, hex_mod, md5_hex, md5_mod

NUM_BUCKETS = 2**15


def hash_buckets(features: DataFrame, num_buckets: int = NUM_BUCKETS) -> DataFrame:
    """Add the feature string and its bucket to single features."""
    text = feature_string(F.col("value"), F.col("feature_id"))
    return features.withColumn("feature", text).withColumn("bucket", md5_mod(F.col("feature"), num_buckets))


def encode_hashed(observations: DataFrame, num_buckets: int = NUM_BUCKETS) -> DataFrame:
    """Sorted bucket ``indices`` and, as ``values``, the number of distinct feature strings in each."""
    carried = [c for c in observations.columns if c != "feats"]
    texts = F.array_distinct(F.transform("feats", lambda value, i: feature_string(value, i)))
    # first the digests, then the buckets: inside a lambda nothing is shared, and a bucket reads its digest often
    digests = F.transform(texts, md5_hex)
    buckets = observations.select(
        *carried, F.array_sort(F.transform(digests, lambda d: hex_mod(d, num_buckets))).alias("_b")
    )
    indexed = buckets.select(*carried, "_b", F.array_distinct("_b").alias("indices"))
    # rows without a collision, nearly all of them, need no counting
    counted = F.transform("indices", lambda b: F.size(F.filter("_b", lambda x: x == b)).cast("double"))
    ones = F.array_repeat(F.lit(1.0), F.size("indices"))
    values = F.when(F.size("indices") == F.size("_b"), ones).otherwise(counted)
    return indexed.select(*carried, "indices", values.alias("values"))
