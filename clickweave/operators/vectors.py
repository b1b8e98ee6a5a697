"""Hand-over to and from ``pyspark.ml``, which has vector and model types of its own."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.descent import BROADCAST_PARAMETERS

# fixed value: how a stored vector says that it is sparse
_SPARSE = 0


def to_vectors(encoded: DataFrame, dimension: int) -> DataFrame:
    """Replace ``indices`` and ``values`` by one sparse ``features`` vector of the given size.

    There is no built-in expression for a sparse vector of given indices; this
    one conversion runs in Python, and hands whole columns through in the
    layout in which vectors are stored.
    """
    carried = [c for c in encoded.columns if c not in ("indices", "values")]

    @F.pandas_udf(VectorUDT())
    def vector(indices: pd.Series, values: pd.Series) -> pd.DataFrame:
        columns = {"type": _SPARSE, "size": dimension, "indices": indices, "values": values}
        return pd.DataFrame(columns, index=indices.index)

    return encoded.select(*carried, vector("indices", "values").alias("features"))


def from_vectors(rows: DataFrame, features: str = "features") -> DataFrame:
    """Replace a column of vectors by sorted ``indices`` and ``values`` of its non-zeros; runs in the JVM."""
    carried = [c for c in rows.columns if c != features]
    parts = F.unwrap_udt(features)
    places = F.when(parts["type"] == _SPARSE, parts["indices"]).otherwise(
        F.transform(parts["values"], lambda v, i: i)
    )
    pairs = F.filter(
        F.arrays_zip(places.cast("array<bigint>").alias("i"), parts["values"].alias("v")), lambda p: p["v"] != 0.0
    )
    listed = rows.select(*carried, F.array_sort(pairs).alias("_pairs"))
    return listed.select(
        *carried, F.col("_pairs")["i"].alias("indices"), F.col("_pairs")["v"].alias("values")
    )


def to_ml_model(
    weights: DataFrame, intercept: float, dimension: int, *, limit: int = BROADCAST_PARAMETERS
) -> LogisticRegressionModel:
    """A ``pyspark.ml`` model with the weights ``(idx, weight)``; indices without a row weigh nothing.

    Spark's model holds a dense vector on the driver and in every task, so more
    than ``limit`` weights are an error: score those with ``predict_proba``.  An
    index outside of the dimension, or one that comes twice, is an error too.
    """
    if dimension > limit:
        raise ValueError(f"{dimension} weights are more than the {limit} that a model of this kind may hold")
    rows = weights.where(F.col("weight").isNotNull()).select("idx", F.col("weight").cast("double").alias("weight"))
    known = rows.agg(F.count("*").alias("n"), F.min("idx").alias("low"), F.max("idx").alias("top")).first()
    if known["n"] and not 0 <= known["low"] <= known["top"] < dimension:
        raise ValueError(f"indices {known['low']} to {known['top']} do not fit the dimension {dimension}")
    if known["n"] > dimension:
        raise ValueError("an index has several weights")
    # bounded by the limit
    table = rows.toArrow()
    at = table["idx"].to_numpy()
    if len(np.unique(at)) < len(at):
        raise ValueError("an index has several weights")
    dense = np.zeros(dimension)
    dense[at] = table["weight"].to_numpy()
    context = weights.sparkSession.sparkContext
    held = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"logreg_{uuid.uuid4().hex[:12]}", _py2java(context, DenseVector(dense)), float(intercept)
    )
    return LogisticRegressionModel(held)


def from_ml_model(spark: SparkSession, model: LogisticRegressionModel) -> tuple[DataFrame, float]:
    """Weights ``(idx, weight)`` and intercept of a binary ``pyspark.ml`` model, however it was trained."""
    if model.numClasses != 2:
        raise ValueError(f"a model of {model.numClasses} classes has no single weight vector")
    dense = model.coefficients.toArray()
    frame = pd.DataFrame({"idx": np.arange(len(dense)), "weight": dense})
    return spark.createDataFrame(frame, "idx bigint, weight double"), float(model.intercept)


def positive_probability(column: str = "probability") -> Column:
    """The chance of label 1 from what a ``pyspark.ml`` classifier returns."""
    return vector_to_array(column)[1]
