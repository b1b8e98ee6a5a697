"""Hyper-parameter search on a fixed validation split."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.descent import TOLERANCE, Fitted, Setting, fit_sgd
from clickweave.operators.scoring import evaluate_models

STEP_SIZES = (1.0, 10.0)
REG_PARAMS = (1e-6, 1e-3)
ITERATIONS = 500


def grid_settings(steps: Sequence[float] = STEP_SIZES, regs: Sequence[float] = REG_PARAMS) -> list[Setting]:
    """All cells, regularisation fastest: the order in which ties are decided."""
    return [Setting(float(s), float(r)) for s, r in product(steps, regs)]


def grid_table(spark: SparkSession, settings: Sequence[Setting]) -> DataFrame:
    rows = [(k, s.step_size, s.reg_param) for k, s in enumerate(settings)]
    return spark.createDataFrame(rows, "grid_order int, step_size double, reg_param double")


def grid_cells(losses: DataFrame, settings: Sequence[Setting]) -> DataFrame:
    """Losses ``(model_id, log_loss)`` as ``(grid_order, step_size, reg_param, log_loss)``."""
    grid = grid_table(losses.sparkSession, settings)
    return grid.join(losses, grid.grid_order == losses.model_id).select(
        "grid_order", "step_size", "reg_param", "log_loss"
    )


def grid_evaluate(
    encoded: DataFrame, weights: DataFrame, intercepts: Sequence[float], settings: Sequence[Setting]
) -> DataFrame:
    """The grid with its log losses; all models are scored in one pass."""
    return grid_cells(evaluate_models(encoded, weights, intercepts), settings)


def grid_search(
    train: DataFrame,
    validation: DataFrame,
    dimension: int,
    settings: Sequence[Setting] | None = None,
    iterations: int = ITERATIONS,
    tol: float = TOLERANCE,
) -> tuple[Fitted, DataFrame]:
    """Fit every cell on ``train`` and score it on ``validation``."""
    settings = list(settings or grid_settings())
    fitted = fit_sgd(train, dimension, settings, iterations, tol)
    return fitted, grid_evaluate(validation, fitted.weights, fitted.intercepts, settings)


def grid_best(grid: DataFrame) -> DataFrame:
    """The cell with the smallest log loss; among equals the one tried first."""
    cell = F.struct("grid_order", "step_size", "reg_param", "log_loss")
    return grid.agg(F.min_by(cell, F.struct("log_loss", "grid_order")).alias("best")).select("best.*")


def grid_matrix(grid: DataFrame, regs: Sequence[float]) -> DataFrame:
    """Step sizes down, regularisation across (columns ``reg_0 ..`` in the order of ``regs``)."""
    cells = [
        F.min(F.when(F.col("reg_param") == F.lit(float(r)), F.col("log_loss"))).alias(f"reg_{k}")
        for k, r in enumerate(regs)
    ]
    return grid.groupBy("step_size").agg(*cells)
