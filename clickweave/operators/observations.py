"""From comma-separated lines to observations and single features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _carried(df: DataFrame, *used: str) -> list[str]:
    return [c for c in df.columns if c not in used]


def parse_observations(lines: DataFrame) -> DataFrame:
    """Field 0 as DOUBLE label, the other fields as strings; empty fields are kept, also trailing ones.

    A label that is no number fails the job under ANSI mode, as it should.
    """
    carried = _carried(lines, "line")
    fields = F.split("line", ",", -1)
    return lines.select(*carried, fields.alias("_f")).select(
        *carried,
        F.col("_f")[0].cast("double").alias("label"),
        F.slice("_f", 2, F.size("_f") - 1).alias("feats"),
    )


def explode_features(observations: DataFrame) -> DataFrame:
    """One row per feature; ``feature_id`` is the 0-based position.

    The outer form with a filter behind it keeps the optimizer from guarding
    the explode with a size test that would parse every line twice.
    """
    carried = _carried(observations, "feats")
    single = observations.select(*carried, F.posexplode_outer("feats").alias("feature_id", "value"))
    return single.where(F.col("feature_id").isNotNull())
