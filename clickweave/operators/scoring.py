"""Applying linear models and measuring log loss."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.scalar import log_loss, probability
from clickweave.operators.profile import explode_encoded, explode_encoded_outer
from clickweave.plans.lookup import BROADCAST_BYTES, fits, hot_keys, left_lookup
from clickweave.plans.scratch import materialize


def hot_indices(encoded: DataFrame) -> DataFrame:
    """The indices that most rows share."""
    return hot_keys(explode_encoded(encoded), ["idx"])


def _dot_products(sent: Broadcast, carried: Sequence[str], intercepts: Sequence[float]):
    """Task function: margins of every model, row by row from the row's own entries."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, weights = sent.value
        for batch in batches:
            lists = batch.column("indices")
            own = lists.flatten().to_numpy()
            val = batch.column("values").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            place = np.minimum(np.searchsorted(idx, own), max(0, len(idx) - 1))
            known = idx[place] == own if len(idx) else np.zeros(len(own), dtype=bool)
            row, val, place = row[known], val[known], place[known]
            sums = [
                pa.array(np.bincount(row, weights=val * weights[place, k], minlength=batch.num_rows) + b)
                for k, b in enumerate(intercepts)
            ]
            names = [*carried, *[f"margin_{k}" for k in range(len(intercepts))]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], *sums], names)

    return score


def margins(
    encoded: DataFrame,
    weights: DataFrame,
    intercepts: Sequence[float],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``margin_0 ..`` (weights . x + intercept), one column per model.

    ``weights`` is ``(idx, weights ARRAY<DOUBLE>)`` with one entry per model, so
    any number of models costs one pass.  While the weights fit the (measured)
    broadcast budget every row is scored where it is.  Beyond it the rows are
    written once with an id of their own; sums by that id are combined before
    the shuffle, and equal rows stay apart.  A row without non-zeros gets its
    intercept.
    """
    spark, n_models = encoded.sparkSession, len(intercepts)
    carried = [c for c in encoded.columns if c not in ("indices", "values")]
    if fits(weights, broadcast_bytes, row_bytes=64 + 8 * n_models):
        table = weights.select("idx", "weights").toArrow().sort_by("idx")
        dense = table["weights"].combine_chunks().flatten().to_numpy().reshape(-1, n_models)
        sent = spark.sparkContext.broadcast((table["idx"].to_numpy(), dense))
        schema = encoded.select(*carried).schema
        for k in range(n_models):
            schema = schema.add(f"margin_{k}", "double")
        rows = encoded.select(*carried, "indices", "values")
        return rows.mapInArrow(_dot_products(sent, carried, [float(b) for b in intercepts]), schema)
    staged = materialize(encoded.withColumn("_row", F.monotonically_increasing_id()), "scored-rows")
    single = explode_encoded_outer(staged)
    found = left_lookup(
        single, weights, ["idx"], ["weights"], small=False, hot=hot_indices(staged), spread="_row"
    )
    sums = [
        (F.coalesce(F.sum(F.col("val") * F.col("weights")[k]), F.lit(0.0)) + F.lit(float(b))).alias(f"margin_{k}")
        for k, b in enumerate(intercepts)
    ]
    return found.groupBy("_row", *carried).agg(*sums).drop("_row")


def predict_proba(
    encoded: DataFrame, weights: DataFrame, intercept: float, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the predicted probability ``p`` of one model ``(idx, weight)``."""
    table = weights.select("idx", F.array("weight").alias("weights"))
    scored = margins(encoded, table, [intercept], broadcast_bytes)
    return scored.withColumn("p", probability(F.col("margin_0"))).drop("margin_0")


def prediction_sum(scored: DataFrame) -> DataFrame:
    return scored.agg(F.sum("p").alias("sum_p"))


def row_log_loss(scored: DataFrame) -> DataFrame:
    return scored.withColumn("log_loss", log_loss(F.col("p"), F.col("label")))


def mean_log_loss(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average log loss of scored rows, overall or per group."""
    return row_log_loss(scored).groupBy(*by).agg(F.avg("log_loss").alias("log_loss"))


def evaluate_model(encoded: DataFrame, weights: DataFrame, intercept: float, by: Sequence[str] = ()) -> DataFrame:
    return mean_log_loss(predict_proba(encoded, weights, intercept), by)


def baseline_log_loss(labelled: DataFrame, fitted_on: str = "train") -> DataFrame:
    """Log loss of always predicting the class rate of one split, for every split.

    The loss depends on the label only, so one scan reduces each split to its
    label counts; the rest is arithmetic on one row per distinct label.
    """
    counts = labelled.groupBy("split", "label").agg(F.count("*").alias("n"))
    fitted_n = F.when(F.col("split") == fitted_on, F.col("n"))
    rate = counts.agg((F.sum(F.col("label") * fitted_n) / F.sum(fitted_n)).alias("rate")).scalar()
    total = F.col("n") * log_loss(F.col("rate"), F.col("label"))
    return (
        counts.withColumn("rate", rate)
        .groupBy("split")
        .agg(
            F.first("rate").alias("class_rate"),
            (F.sum(total) / F.sum("n")).alias("log_loss"),
        )
    )


def smallest_weights(weights: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest weights, ties by index."""
    return weights.orderBy("weight", "idx").limit(k)


def evaluate_models(
    encoded: DataFrame,
    weights: DataFrame,
    intercepts: Sequence[float],
    by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mean log loss of every model, ``(*by, model_id INT, log_loss)``, in one job."""
    scored = margins(encoded, weights, intercepts, broadcast_bytes)
    per_model = F.array(*[F.col(f"margin_{k}") for k in range(len(intercepts))])
    single = scored.select(*by, "label", F.posexplode_outer(per_model).alias("model_id", "margin"))
    loss = log_loss(probability(F.col("margin")), F.col("label"))
    return single.groupBy(*by, "model_id").agg(F.avg(loss).alias("log_loss"))
