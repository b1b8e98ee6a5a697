"""One-hot encoding through a dictionary fitted on the training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.operators.observations import explode_features
from clickweave.plans.lookup import BROADCAST_BYTES, anti_lookup, hot_keys, left_lookup, table_bytes
from clickweave.plans.prefix import dense_index
from clickweave.plans.scratch import materialize

_KEY = ["feature_id", "value"]
# more columns than this are not looked up position by position
MAX_POSITION_JOINS = 64


def fit_dictionary(observations: DataFrame) -> DataFrame:
    """Distinct ``(feature_id, value)`` with a dense ``idx`` in that order and its row count ``n``.

    Counting first means a value held by a third of all rows is one row per
    task before anything moves.
    """
    counts = explode_features(observations).groupBy(*_KEY).agg(F.count("*").alias("n"))
    return dense_index(counts, _KEY).select("feature_id", "value", "idx", "n")


def dictionary_size(dictionary: DataFrame) -> DataFrame:
    """Dimension of the encoded space."""
    return dictionary.agg(F.count("*").alias("dimension"))


def _near_positions(dictionary: DataFrame, broadcast_bytes: int) -> tuple[list[int], int, int]:
    """Positions whose entries may be broadcast together, smallest first; bytes of the rest; bytes still free."""
    size = table_bytes(F.lit(1), F.col("value"))
    sizes = dictionary.groupBy("feature_id").agg(size.alias("bytes")).collect()
    near, left = [], broadcast_bytes
    for row in sorted(sizes, key=lambda r: (r["bytes"], r["feature_id"])):
        if row["bytes"] > left or len(near) == MAX_POSITION_JOINS:
            break
        near.append(row["feature_id"])
        left -= row["bytes"]
    rest = sum(r["bytes"] for r in sizes) - (broadcast_bytes - left)
    return sorted(near), rest, left


def _look_up_near(observations: DataFrame, dictionary: DataFrame, near: list[int]) -> DataFrame:
    """Add ``_near``: one broadcast join per position, so no row moves."""
    wide = observations
    for f in near:
        entries = dictionary.where(F.col("feature_id") == f).select(
            F.col("value").alias(f"_value_{f}"), F.col("idx").alias(f"_idx_{f}")
        )
        wide = wide.join(F.broadcast(entries), F.get("feats", F.lit(f)) == F.col(f"_value_{f}"), "left")
    found = F.array(*[F.col(f"_idx_{f}") for f in near]).cast("array<bigint>")
    return wide.select(*observations.columns, F.array_compact(found).alias("_near"))


def _look_up_far(wide: DataFrame, dictionary: DataFrame, near: list[int], small: bool) -> DataFrame:
    """Add ``_far``: the other positions as single features, gathered again by the ``_row`` they came from."""
    carried = [c for c in wide.columns if c not in ("feats", "_near")]
    named = F.transform("feats", lambda value, i: F.struct(i.alias("feature_id"), value.alias("value")))
    others = F.filter(named, lambda x: ~x["feature_id"].isin(near)) if near else named
    single = wide.select(*carried, "_near", F.inline_outer(others).alias("feature_id", "value"))
    entries = dictionary.where(~F.col("feature_id").isin(near)) if near else dictionary
    hot = None
    if not small:
        # counted on the rows alone, without the lookups made so far
        hot = hot_keys(wide.select(F.inline(others).alias("feature_id", "value")), _KEY)
    found = left_lookup(single, entries, _KEY, ["idx"], small=small, hot=hot, spread="_row")
    return found.groupBy(*carried).agg(F.first("_near").alias("_near"), F.collect_list("idx").alias("_far"))


def encode_ohe(
    observations: DataFrame, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Sorted ``indices`` and 1.0 ``values`` per observation.

    Values missing from the dictionary are dropped; an observation without any
    known value stays, with empty arrays; equal observations stay apart.
    Positions with few categories, often all of them, are looked up in place;
    only positions too large to broadcast are shuffled, and then the rows are
    written first with an id of their own, by which they are gathered again.
    """
    carried = [c for c in observations.columns if c != "feats"]
    near, rest, free = _near_positions(dictionary, broadcast_bytes)
    if rest:
        numbered = observations.withColumn("_row", F.monotonically_increasing_id())
        observations = materialize(numbered, "observations")
    encoded = _look_up_near(observations, dictionary, near)
    found = F.col("_near")
    if rest:
        encoded = _look_up_far(encoded, dictionary, near, small=rest <= free)
        found = F.concat("_near", "_far")
    indexed = encoded.select(*carried, F.array_sort(found).alias("indices"))
    return indexed.withColumn("values", F.array_repeat(F.lit(1.0), F.size("indices")))


def unseen_features(
    observations: DataFrame, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The single features that encoding drops."""
    single = explode_features(observations)
    small = dictionary.agg(table_bytes(F.lit(1), F.col("value")).alias("bytes")).first()["bytes"] <= broadcast_bytes
    hot = None if small else hot_keys(single, _KEY)
    return anti_lookup(single, dictionary, _KEY, small=small, hot=hot).select(*single.columns)
