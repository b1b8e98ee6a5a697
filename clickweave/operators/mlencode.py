"""One-hot encoding by ``pyspark.ml`` stages, for use inside a pipeline of that kind.

It gives the vectors of :func:`clickweave.operators.onehot.encode_ohe`: the same
dimension, the same index per category, nothing for unseen values.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.operators.observations import explode_features
from clickweave.plans.lookup import BROADCAST_BYTES, table_bytes

# no category may be the empty string there; a common first letter avoids that and keeps the order of values
_PREFIX = "="


def _columns(observations: DataFrame, positions: int) -> DataFrame:
    """One string column per position; a position that a row does not have is NULL."""
    texts = {f"_text_{i}": F.concat(F.lit(_PREFIX), F.get("feats", F.lit(i))) for i in range(positions)}
    return observations.withColumns(texts)


def fit_ml_encoder(observations: DataFrame, *, limit: int = BROADCAST_BYTES) -> PipelineModel:
    """Indexers, encoder and assembler fitted on all positions of ``observations(feats)``.

    Spark's indexer gathers the categories on the driver, so they are measured
    first; more bytes than ``limit`` are an error: such a dictionary stays a table
    with ``fit_dictionary``.
    """
    single = explode_features(observations).groupBy("feature_id", "value").agg(F.count("*").alias("n"))
    known = single.agg(
        F.coalesce(F.max("feature_id"), F.lit(-1)).alias("last"), table_bytes(F.lit(1), F.col("value")).alias("bytes")
    ).first()
    if known["bytes"] > limit:
        raise ValueError(f"categories take {known['bytes']} bytes, more than {limit}")
    positions = known["last"] + 1
    if not positions:
        raise ValueError("no observation has a feature")
    texts, places, blocks = ([f"_{kind}_{i}" for i in range(positions)] for kind in ("text", "place", "block"))
    stages = [
        # values in order; one place more, behind the others, for what is unseen
        StringIndexer(inputCols=texts, outputCols=places, handleInvalid="keep", stringOrderType="alphabetAsc"),
        # that last place is the one left out, so unseen values have no entry
        OneHotEncoder(inputCols=places, outputCols=blocks, handleInvalid="error", dropLast=True),
        VectorAssembler(inputCols=blocks, outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(_columns(observations, positions))


def ml_dimension(model: PipelineModel) -> int:
    """Categories of all positions."""
    return sum(len(labels) for labels in model.stages[0].labelsArray)


def encode_ml(observations: DataFrame, model: PipelineModel) -> DataFrame:
    """Observations with a sparse ``features`` vector in place of ``feats``.

    Positions beyond those the encoder was fitted on are unseen.
    """
    carried = [c for c in observations.columns if c != "feats"]
    positions = len(model.stages[0].labelsArray)
    return model.transform(_columns(observations, positions)).select(*carried, "features")
