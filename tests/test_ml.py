"""Hand-over to and from pyspark.ml."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickweave.operators import mlencode, onehot, scoring, vectors

DIMENSION = 9


@pytest.fixture(scope="module")
def encoded(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(200):
        idx = sorted(rng.choice(DIMENSION, int(rng.integers(0, 4)), replace=False).tolist())
        rows.append((i, float(rng.random() < (0.8 if 3 in idx else 0.3)), idx, [float(v) for v in rng.normal(0, 2, len(idx))]))
    return spark.createDataFrame(rows, "obs_id bigint, label double, indices array<bigint>, values array<double>")


def model_rows(spark):
    # index 4 has no weight
    return spark.createDataFrame([(i, 0.3 * i - 1.0) for i in range(DIMENSION) if i != 4], "idx bigint, weight double")


def scores(df, column="p"):
    return np.array([r[column] for r in df.orderBy("obs_id").collect()])


def test_given_weights_score_the_same(spark, encoded):
    model = vectors.to_ml_model(model_rows(spark), -0.25, DIMENSION)
    by_ml = model.transform(vectors.to_vectors(encoded, DIMENSION)).withColumn("p", vectors.positive_probability())
    assert np.allclose(scores(by_ml), scores(scoring.predict_proba(encoded, model_rows(spark), -0.25)), atol=1e-9)
    assert model.numFeatures == DIMENSION and model.numClasses == 2


def test_trained_weights_come_back(spark, encoded):
    points = vectors.to_vectors(encoded, DIMENSION)
    for spread in (True, False):
        trained = LogisticRegression(maxIter=5, regParam=0.01, standardization=spread).fit(points)
        weights, intercept = vectors.from_ml_model(spark, trained)
        expected = scores(trained.transform(points).withColumn("p", vectors.positive_probability()))
        assert np.allclose(scores(scoring.predict_proba(encoded, weights, intercept)), expected, atol=1e-9)


def test_round_trip_and_saving(spark, encoded, tmp_path):
    model = vectors.to_ml_model(model_rows(spark), 0.5, DIMENSION)
    weights, intercept = vectors.from_ml_model(spark, model)
    found = {r.idx: r.weight for r in weights.collect()}
    assert intercept == 0.5 and found == {r.idx: r.weight for r in model_rows(spark).collect()} | {4: 0.0}
    model.write().overwrite().save(f"{tmp_path}/model")
    again = type(model).load(f"{tmp_path}/model")
    assert again.coefficients == model.coefficients and again.intercept == 0.5


@pytest.mark.parametrize("bad", [[(9, 1.0)], [(-1, 1.0)], [(2, 1.0), (2, 2.0)]])
def test_wrong_indices_are_errors(spark, bad):
    with pytest.raises(ValueError):
        vectors.to_ml_model(spark.createDataFrame(bad, "idx bigint, weight double"), 0.0, DIMENSION)


def test_models_too_large_are_errors(spark):
    with pytest.raises(ValueError, match="more than"):
        vectors.to_ml_model(model_rows(spark), 0.0, DIMENSION, limit=8)
    empty = spark.createDataFrame([], "idx bigint, weight double")
    assert vectors.to_ml_model(empty, 1.0, 3).coefficients.toArray().tolist() == [0.0, 0.0, 0.0]


def test_vectors_come_back(spark, encoded):
    back = vectors.from_vectors(vectors.to_vectors(encoded, DIMENSION))
    assert sorted(map(str, back.collect())) == sorted(map(str, encoded.collect()))
    odd = [(1, Vectors.dense([0.0, 2.0, 0.0])), (2, Vectors.sparse(5, [1, 4], [0.0, 3.0])), (3, Vectors.sparse(5, [], []))]
    found = vectors.from_vectors(spark.createDataFrame(odd, ["obs_id", "features"])).orderBy("obs_id").collect()
    assert [(r.indices, r["values"]) for r in found] == [([1], [2.0]), ([4], [3.0]), ([], [])]


OBSERVATIONS = [
    (1, "train", ["a", "", "x"]),
    (2, "train", ["b", "=", "x"]),
    (3, "train", ["", "z", "é"]),
    (4, "train", ["B", " ", "中"]),
    (5, "test", ["new", "", "x"]),
    (6, "test", ["new", "new", "new"]),
    (7, "test", ["a"]),
    (8, "test", ["a", "z", "x", "beyond"]),
    (9, "test", []),
]


@pytest.fixture(scope="module")
def observations(spark):
    return spark.createDataFrame(OBSERVATIONS, "obs_id bigint, split string, feats array<string>")


def test_ml_encoding_equals_ours(spark, observations):
    train = observations.where("split = 'train'")
    dictionary = onehot.fit_dictionary(train)
    model = mlencode.fit_ml_encoder(train)
    assert mlencode.ml_dimension(model) == dictionary.count()
    ours = {r.obs_id: (r.indices, r["values"]) for r in onehot.encode_ohe(observations, dictionary).collect()}
    found = mlencode.encode_ml(observations, model)
    assert found.columns == ["obs_id", "split", "features"]
    assert {r.obs_id: r.features.size for r in found.collect()} == dict.fromkeys(ours, dictionary.count())
    theirs = {r.obs_id: (r.indices, r["values"]) for r in vectors.from_vectors(found).collect()}
    assert theirs == ours
    # nothing known, nothing set
    assert theirs[6] == ([], []) and theirs[9] == ([], [])


def test_too_many_categories_are_an_error(observations):
    with pytest.raises(ValueError, match="bytes"):
        mlencode.fit_ml_encoder(observations, limit=100)
    with pytest.raises(ValueError, match="no observation"):
        mlencode.fit_ml_encoder(observations.where(F.size("feats") == 0))
