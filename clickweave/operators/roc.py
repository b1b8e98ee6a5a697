"""ROC curves without collecting or sorting on one node."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.plans.prefix import running_totals


def _rates(totals: DataFrame) -> list[Column]:
    """tpr and fpr against the totals; NULL where a class is absent."""
    positives = totals.agg(F.sum("_pos").alias("x")).scalar()
    negatives = totals.agg((F.sum("_n") - F.sum("_pos")).alias("x")).scalar()
    return [
        F.try_divide("tp", positives).alias("tpr"),
        F.try_divide("fp", negatives).alias("fpr"),
    ]


def roc_points(scored: DataFrame) -> DataFrame:
    """One point per row, by falling score with ties in key order: running tp / fp and their rates."""
    order = [F.desc("p"), F.asc("obs_id")]
    rows = scored.select("obs_id", "label", "p", F.lit(1).cast("bigint").alias("_n"))
    ranked = running_totals(rows, order, {"rank": "_n", "tp": "label"})
    points = ranked.withColumn("fp", F.col("rank") - F.col("tp"))
    totals = ranked.select("_n", F.col("label").alias("_pos"))
    return points.select("obs_id", "p", "rank", "tp", "fp", *_rates(totals))


def roc_curve(scored: DataFrame) -> DataFrame:
    """One point per distinct score, tie-safe.

    Rows are counted per score before they are ordered, so a score shared by a
    third of all rows is a single row by then.
    """
    counts = scored.groupBy("p").agg(F.count("*").alias("_n"), F.sum("label").alias("_pos"))
    ranked = running_totals(counts, [F.desc("p")], {"_seen": "_n", "tp": "_pos"})
    points = ranked.withColumn("fp", F.col("_seen") - F.col("tp"))
    return points.select(F.col("p").alias("threshold"), "tp", "fp", *_rates(ranked))
