"""The whole study in one call: search, pick, and compare with the baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.operators.descent import TOLERANCE, Setting, fit_sgd
from clickweave.operators.grid import ITERATIONS, grid_best, grid_cells, grid_settings
from clickweave.operators.scoring import baseline_log_loss, evaluate_models, predict_proba, row_log_loss
from clickweave.operators.splits import CachedSplits
from clickweave.plans.scratch import materialize


def trained_scores(
    encoded: DataFrame, dimension: int, setting: Setting, iterations: int, tol: float = TOLERANCE
) -> DataFrame:
    """Scores ``p`` of all rows under one model that is fitted on the ``train`` rows."""
    fitted = fit_sgd(encoded.where(F.col("split") == "train"), dimension, [setting], iterations, tol)
    return predict_proba(encoded, fitted.model(), fitted.intercepts[0])


def model_report(
    encoded: DataFrame, dimension: int, setting: Setting, iterations: int, tol: float = TOLERANCE
) -> DataFrame:
    """Log loss of one trained model and of the baseline, and the sum of its predictions, per split.

    The encoded rows are computed once and released before this returns.
    """
    with CachedSplits(encoded) as parts:
        scored = row_log_loss(trained_scores(parts.rows, dimension, setting, iterations, tol))
        per_split = scored.groupBy("split").agg(F.avg("log_loss").alias("log_loss"), F.sum("p").alias("sum_p"))
        baseline = baseline_log_loss(parts.rows).select("split", F.col("log_loss").alias("baseline_log_loss"))
        joined = per_split.join(baseline, "split").select("split", "log_loss", "baseline_log_loss", "sum_p")
        return materialize(joined, "model-report")


def report(
    encoded: DataFrame,
    dimension: int,
    settings: Sequence[Setting] | None = None,
    iterations: int = ITERATIONS,
    tol: float = TOLERANCE,
) -> DataFrame:
    """Log loss of the best model and of the baseline, per split.

    ``encoded`` carries ``split``; models are fitted on ``train`` and chosen on
    ``validation``.  Its rows are computed once and released before this returns.
    """
    settings = list(settings or grid_settings())
    with CachedSplits(encoded) as parts:
        fitted = fit_sgd(parts["train"], dimension, settings, iterations, tol)
        # all models on all splits in one pass; the choice then needs the validation losses only
        losses = evaluate_models(parts.rows, fitted.weights, fitted.intercepts, ["split"])
        losses = materialize(losses, "losses")
        baseline = baseline_log_loss(parts.rows).select("split", F.col("log_loss").alias("baseline_log_loss"))
        baseline = materialize(baseline, "baseline")
    best = grid_best(grid_cells(losses.where(F.col("split") == "validation"), settings)).first()
    model = losses.where(F.col("model_id") == best["grid_order"])
    return model.join(baseline, "split").select(
        "split",
        F.lit(best["step_size"]).alias("step_size"),
        F.lit(best["reg_param"]).alias("reg_param"),
        "log_loss",
        "baseline_log_loss",
    )
