import math
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickweave.operators import descent, grid, roc, scoring
from clickweave.operators.descent import Setting
from clickweave.workflow import model_report, report, trained_scores

DIMENSION = 12


@pytest.fixture(scope="module")
def encoded(spark):
    """Sparse rows with values other than 1, some of them empty."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        size = 0 if i % 25 == 0 else int(rng.integers(1, 5))
        idx = sorted(rng.choice(DIMENSION - 1, size, replace=False).tolist())
        val = rng.integers(1, 3, size).astype(float).tolist()
        label = float(rng.random() < (0.7 if 2 in idx else 0.25))
        split = "train" if i % 4 else ("validation" if i % 8 else "test")
        rows.append((i, split, label, idx, val))
    return spark.createDataFrame(
        rows, "obs_id bigint, split string, label double, indices array<bigint>, values array<double>"
    ).repartition(5).persist()


def _dense(encoded):
    rows = encoded.orderBy("obs_id").collect()
    x = np.zeros((len(rows), DIMENSION))
    for i, r in enumerate(rows):
        x[i, r["indices"]] = r["values"]
    return x, np.array([r["label"] for r in rows])


def _loop(x, y, setting, iterations, tol, intercept=True, drawn=None):
    """The update rule, written out densely; ``drawn`` says which rows a step uses."""
    w = np.zeros(x.shape[1] + 1)
    w[-1] = 1.0 if intercept else 0.0
    x = np.hstack([x, np.full((len(x), 1), float(intercept))])
    for i in range(1, iterations + 1):
        inside = np.ones(len(y), dtype=bool) if drawn is None else drawn(i)
        if not inside.any():
            continue
        p = 1 / (1 + np.exp(-x[inside] @ w))
        eta = setting.step_size / math.sqrt(i)
        new = w - eta * x[inside].T @ (p - y[inside]) / inside.sum()
        if setting.reg_type == "l2":
            new -= eta * setting.reg_param * w
        if setting.reg_type == "l1":
            new = np.sign(new) * np.maximum(0, np.abs(new) - eta * setting.reg_param)
        stop = i > 1 and np.linalg.norm(new - w) < tol * max(np.linalg.norm(new), 1)
        w = new
        if stop:
            break
    return w, i


def _weights(fitted, k=0):
    w = np.zeros(DIMENSION)
    for r in fitted.model(k).collect():
        w[r["idx"]] = r["weight"]
    return w


PATHS = {
    "broadcast": {},
    "table": {"broadcast_parameters": 0},
    "shuffled": {"broadcast_parameters": 0, "broadcast_bytes": 0},
}
SETTINGS = [Setting(1.0, 1e-6), Setting(10.0, 1e-3), Setting(3.0, 0.1)]


@pytest.mark.parametrize("path", ["broadcast", "reduced", "table", "shuffled"])
def test_fit_matches_the_rule(encoded, path, monkeypatch):
    if path == "reduced":
        # as if the tasks returned more than one reducer may add up
        monkeypatch.setattr(descent, "SHARES_PER_REDUCER", 50)
        monkeypatch.setattr(descent, "ROWS_PER_TASK", 100)
    options = {
        "reduced": {},
        "broadcast": {},
        "table": {"broadcast_parameters": 0},
        "shuffled": {"broadcast_parameters": 0, "broadcast_bytes": 0},
    }[path]
    iterations = 25 if path == "broadcast" else 4
    fitted = descent.fit_sgd(encoded, DIMENSION, SETTINGS, iterations, 1e-3, **options)
    x, y = _dense(encoded)
    for k, setting in enumerate(SETTINGS):
        w, used = _loop(x, y, setting, iterations, 1e-3)
        assert np.allclose(_weights(fitted, k), w[:-1], atol=1e-9)
        assert fitted.intercepts[k] == pytest.approx(w[-1], abs=1e-9)
        assert fitted.iterations[k] == used
    # all indices have a weight, untouched ones too
    assert fitted.weights.count() == DIMENSION


def test_converged_models_stop_on_their_own(encoded):
    settings = [Setting(1.0, 1e-6), Setting(1.0, 5.0)]
    for options in ({}, {"broadcast_parameters": 0}):
        iterations = 12
        fitted = descent.fit_sgd(encoded, DIMENSION, settings, iterations, 0.05, **options)
        x, y = _dense(encoded)
        expected = [_loop(x, y, s, iterations, 0.05) for s in settings]
        assert fitted.iterations == [used for _, used in expected]
        assert len(set(fitted.iterations)) == 2
        for k, (w, _) in enumerate(expected):
            assert np.allclose(_weights(fitted, k), w[:-1], atol=1e-9)


def test_fit_matches_mllib(spark, encoded):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import SparseVector
    from pyspark.mllib.regression import LabeledPoint

    points = encoded.rdd.map(lambda r: LabeledPoint(r.label, SparseVector(DIMENSION, r.indices, r["values"]))).cache()
    model = LogisticRegressionWithSGD.train(points, 20, 10.0, regParam=1e-3, regType="l2", intercept=True)
    fitted = descent.fit_sgd(encoded, DIMENSION, [Setting(10.0, 1e-3)], 20)
    assert np.allclose(_weights(fitted), model.weights.toArray(), atol=1e-9)
    assert fitted.intercepts[0] == pytest.approx(model.intercept, abs=1e-9)


OTHER_SETTINGS = [Setting(1.0, 1e-2, "l1"), Setting(10.0, 0.05, "l1"), Setting(2.0, 0.3, None), Setting(1.0, 1e-2)]


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("path", ["broadcast", "table", "shuffled"])
def test_kinds_of_regularisation(encoded, path, intercept):
    iterations = 25 if path == "broadcast" else 3
    fitted = descent.fit_sgd(encoded, DIMENSION, OTHER_SETTINGS, iterations, 1e-3, intercept=intercept, **PATHS[path])
    x, y = _dense(encoded)
    for k, setting in enumerate(OTHER_SETTINGS):
        w, used = _loop(x, y, setting, iterations, 1e-3, intercept)
        assert np.allclose(_weights(fitted, k), w[:-1], atol=1e-9)
        assert fitted.intercepts[k] == (pytest.approx(w[-1], abs=1e-9) if intercept else 0.0)
        assert fitted.iterations[k] == used
    if path == "broadcast":
        # the proximal step makes weights exactly zero
        assert np.count_nonzero(_weights(fitted, 1)) < np.count_nonzero(_weights(fitted, 2))
    assert fitted.weights.count() == DIMENSION


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("reg_type", ["l1", "l2", None])
def test_other_fits_match_mllib(spark, encoded, reg_type, intercept):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.linalg import SparseVector
    from pyspark.mllib.regression import LabeledPoint

    points = encoded.rdd.map(lambda r: LabeledPoint(r.label, SparseVector(DIMENSION, r.indices, r["values"]))).cache()
    model = LogisticRegressionWithSGD.train(points, 15, 5.0, regParam=1e-2, regType=reg_type, intercept=intercept)
    for path in ("broadcast", "table"):
        fitted = descent.fit_sgd(
            encoded, DIMENSION, [Setting(5.0, 1e-2, reg_type)], 15, intercept=intercept, **PATHS[path]
        )
        assert np.allclose(_weights(fitted), model.weights.toArray(), atol=1e-9)
        assert fitted.intercepts[0] == pytest.approx(model.intercept, abs=1e-9)


def test_draws_agree_and_have_their_share(spark):
    ids = spark.range(20000).select(F.col("id").alias("obs_id"))
    batches = descent.Batches(0.3)
    masks = []
    for step in (1, 2, 500):
        table = ids.select("obs_id", batches.base().alias("b")).withColumn("d", batches.drawn(F.col("b"), step))
        rows = table.orderBy("obs_id").collect()
        mask = np.array([r.d for r in rows])
        assert (batches.drawn_array(np.array([r.b for r in rows]).astype(np.uint64), step) == mask).all()
        assert abs(mask.mean() - 0.3) < 0.02
        masks.append(mask)
    # steps draw independently of each other
    assert abs((masks[0] & masks[1]).mean() - 0.09) < 0.02


@pytest.mark.parametrize("path", ["broadcast", "table", "shuffled"])
def test_batches(spark, encoded, path):
    batches = descent.Batches(0.25, seed=7)
    iterations = 12 if path == "broadcast" else 3
    settings = [Setting(1.0, 1e-2, "l1"), Setting(3.0, 1e-3)]
    # another layout of the rows draws the same
    again = encoded.repartition(2, "label")
    bases = [r.b for r in encoded.select("obs_id", batches.base().alias("b")).orderBy("obs_id").collect()]
    bases = np.array(bases).astype(np.uint64)
    x, y = _dense(encoded)
    for table in (encoded, again):
        fitted = descent.fit_sgd(table, DIMENSION, settings, iterations, 1e-3, batches=batches, **PATHS[path])
        for k, setting in enumerate(settings):
            w, used = _loop(x, y, setting, iterations, 1e-3, drawn=lambda i: batches.drawn_array(bases, i))
            assert np.allclose(_weights(fitted, k), w[:-1], atol=1e-9)
            assert fitted.iterations[k] == used


@pytest.mark.parametrize("path", ["broadcast", "table"])
def test_batches_of_nothing_change_nothing(encoded, path):
    few = encoded.where("obs_id < 3")
    batches = descent.Batches(1e-9)
    fitted = descent.fit_sgd(few, DIMENSION, [Setting(1.0, 0.1)], 3, batches=batches, **PATHS[path])
    assert fitted.intercepts == [descent.INITIAL_INTERCEPT] and not _weights(fitted).any()
    assert fitted.iterations == [0]


@pytest.mark.parametrize("path", ["broadcast", "table"])
def test_fit_on_no_rows(encoded, path):
    fitted = descent.fit_sgd(encoded.limit(0), DIMENSION, [Setting(1.0, 0.1)], 2, **PATHS[path])
    assert fitted.iterations == [0] and not _weights(fitted).any()


def test_wrong_choices_are_errors():
    with pytest.raises(ValueError, match="regularisation"):
        Setting(1.0, 0.1, "l3")
    for fraction in (0.0, 1.5):
        with pytest.raises(ValueError, match="share"):
            descent.Batches(fraction)


def test_blocks_are_cut_by_rows_and_entries(encoded, monkeypatch):
    """Any cut of the rows into blocks, and any number of blocks at once, gives the same weights."""
    plain = _weights(descent.fit_sgd(encoded, DIMENSION, SETTINGS[:1], 5))
    for rows, entries, at_once in [(1, 1 << 17, 1), (7, 3, 10), (10**6, 1 << 17, 1 << 21)]:
        monkeypatch.setattr(descent, "ROWS_PER_BLOCK", rows)
        monkeypatch.setattr(descent, "ENTRIES_PER_BLOCK", entries)
        monkeypatch.setattr(descent, "ENTRIES_AT_ONCE", at_once)
        assert np.allclose(_weights(descent.fit_sgd(encoded, DIMENSION, SETTINGS[:1], 5)), plain, atol=1e-12)


def test_shares_are_added_before_they_are_sent(encoded, monkeypatch):
    """Where the tasks' shares overlap, the driver gets the sum of them, not each."""
    plain = [_weights(descent.fit_sgd(encoded, DIMENSION, SETTINGS, 5), k) for k in range(len(SETTINGS))]
    original, reducers = descent._gradient, []

    def counting(blocks, weights, models, n, *rest):
        reducers.append(n)
        return original(blocks, weights, models, n, *rest)

    monkeypatch.setattr(descent, "_gradient", counting)
    monkeypatch.setattr(descent, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(descent, "NUMBERS_ADDED_HERE", 0, raising=False)
    monkeypatch.setattr(descent, "PIECE", 7, raising=False)
    fitted = descent.fit_sgd(encoded, DIMENSION, SETTINGS, 5)
    assert reducers[0] == 0 and all(n > 0 for n in reducers[1:]) and len(reducers) > 2
    for k, w in enumerate(plain):
        assert np.allclose(_weights(fitted, k), w, atol=1e-12)


def test_room_of_a_gradient_share_does_not_grow_with_its_rows():
    """Four times the rows of a task take no more room at a time."""
    rng = np.random.default_rng(5)
    sent = SimpleNamespace(value=np.zeros((1, 1001)))

    def room(rows):
        idx = pa.array(rng.integers(0, 1000, 4 * rows))
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * 4), v) for v in
                 (idx, pa.array(np.ones(4 * rows)))]
        batch = pa.RecordBatch.from_arrays([pa.array(np.ones(rows)), *lists], ["label", "indices", "values"])
        blocks = list(descent._pack(iter([batch])))
        assert sum(b.nbytes for b in blocks) < 30 * rows
        share = descent._gradient_shares(sent, [0], True, None, descent.ENTRIES_AT_ONCE)
        tracemalloc.start()
        try:
            found = list(share(iter(blocks)))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert sum(b["used"][0].as_py() for b in found) == rows
        return peak

    assert room(400_000) < 1.2 * room(100_000)


def test_tasks_follow_the_row_count(spark, monkeypatch):
    monkeypatch.setattr(descent, "ROWS_PER_TASK", 100)
    for parts, rows, expected in [(1, 50, 1), (1, 350, 4), (7, 350, 4), (3, 250, 3)]:
        kept = spark.range(0, rows, 1, parts)
        assert descent._spread(kept, rows).rdd.getNumPartitions() == expected


def test_many_partitions_give_few_shares(spark):
    cores = spark.sparkContext.defaultParallelism
    kept = spark.range(0, 10**9, 1, 50 * cores)
    assert descent._spread(kept, 10**9).rdd.getNumPartitions() == descent.TASKS_PER_CORE * cores


@pytest.fixture(scope="module")
def repeated(spark):
    """Equal rows, under one id, and an id with different rows."""
    rows = [(7, 1.0, [0, 2], [1.0, 1.0])] * 3 + [(7, 0.0, [1], [2.0]), (8, 0.0, [], []), (8, 0.0, [], [])]
    return spark.createDataFrame(
        rows, "obs_id bigint, label double, indices array<bigint>, values array<double>"
    ).repartition(2)


@pytest.mark.parametrize("path", PATHS)
def test_equal_rows_count_singly_in_every_fit(repeated, path):
    x = np.array([[1.0, 0, 1]] * 3 + [[0, 2.0, 0], [0, 0, 0], [0, 0, 0]])
    w, _ = _loop(x, np.array([1.0, 1, 1, 0, 0, 0]), SETTINGS[0], 3, 0.0)
    fitted = descent.fit_sgd(repeated, 3, SETTINGS[:1], 3, 0.0, **PATHS[path])
    assert fitted.intercepts[0] == pytest.approx(w[-1], abs=1e-9)
    assert np.allclose(sorted(r["weight"] for r in fitted.model().collect()), sorted(w[:-1]), atol=1e-9)


@pytest.mark.parametrize("limit", [scoring.BROADCAST_BYTES, 0])
def test_equal_rows_are_scored_singly(spark, repeated, limit):
    found = scoring.predict_proba(repeated, _fixed(spark), 0.5, limit).collect()
    assert len(found) == 6
    sure, other, empty = (1 / (1 + math.exp(-m)) for m in (0.5 - 0.4 - 0.2, 0.5 - 2 * 0.3, 0.5))
    expected = sorted([sure] * 3 + [other] + [empty] * 2)
    assert np.allclose(sorted(r["p"] for r in found), expected)


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("dimension", [1, DIMENSION - 2])
def test_wrong_dimension_is_an_error(encoded, path, dimension):
    with pytest.raises(ValueError, match="does not fit"):
        descent.fit_sgd(encoded, dimension, SETTINGS[:1], 1, **PATHS[path])


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_moves_no_row(spark, encoded):
    plan = _executed(scoring.predict_proba(encoded, _fixed(spark), 0.0))
    # below the relation is how the rows were cached
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_large_weights_do_not_move_the_entries(spark, encoded):
    """What is shuffled are weights, and sums per row or index; never the label-index-value entries."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    entries = descent.bias_entries(descent.training_rows(encoded)).persist()
    hot = descent.hot_keys(entries, ["idx"])
    by_index = descent.entries_by_index(entries, hot).persist()
    try:
        weights = descent.initial_weights(spark, DIMENSION)
        step = descent.gd_step(entries, weights, 400, 1, SETTINGS[:1], by_index=by_index, hot=hot)
        plan = _executed(step).split("InMemoryRelation")[0]
        depth = {}
        for line in plan.splitlines():
            indent = len(line) - len(line.lstrip(" :+-"))
            depth = {d: l for d, l in depth.items() if d < indent} | {indent: line}
            if "InMemoryTableScan" in line:
                above = [depth[d] for d in sorted(depth, reverse=True)][1:]
                first = next(l for l in above if "Exchange" in l or "Aggregate" in l or "Join" in l)
                # on the way up an aggregate or the join comes before any exchange
                assert "Exchange" not in first or "Broadcast" in first, plan
        assert step.count() == DIMENSION + 1
    finally:
        entries.unpersist()
        by_index.unpersist()
        for k, v in before.items():
            spark.conf.set(k, v)


def test_large_fits_encode_their_rows_once(spark, encoded):
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    rows = encoded.select("label", "indices", "values")
    counted = rows.mapInArrow(count, rows.schema)
    descent.fit_sgd(counted, DIMENSION, SETTINGS[:1], 2, 0.0, **PATHS["shuffled"])
    assert passed.value == 400


def test_two_weight_tables_at_most(spark, encoded, tmp_path, monkeypatch):
    seen = []
    original = descent.materialize

    def counting(df, name, path=None):
        table = original(df, name, path)
        seen.append(len(list(tmp_path.glob("weights-*"))))
        return table

    monkeypatch.setattr(descent, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{len(seen)}")
    monkeypatch.setattr(descent, "materialize", counting)
    descent.fit_sgd(encoded, DIMENSION, SETTINGS[:1], 6, 0.0, broadcast_parameters=0)
    # the next one is written before the oldest goes
    assert max(seen) <= 3 and len(list(tmp_path.glob("weights-*"))) == 2


def _fixed(spark):
    return spark.range(DIMENSION).select(F.col("id").alias("idx"), (F.col("id") / 10.0 - 0.4).alias("weight"))


@pytest.mark.parametrize("limit", [scoring.BROADCAST_BYTES, 0])
def test_predictions(spark, encoded, limit):
    scored = {r["obs_id"]: r["p"] for r in scoring.predict_proba(encoded, _fixed(spark), -0.5, limit).collect()}
    x, _ = _dense(encoded)
    expected = 1 / (1 + np.exp(-(x @ (np.arange(DIMENSION) / 10.0 - 0.4) - 0.5)))
    assert len(scored) == 400
    assert np.allclose([scored[i] for i in range(400)], expected)
    # no non-zeros: the intercept alone
    assert scored[0] == pytest.approx(1 / (1 + math.exp(0.5)))


def test_many_models_equal_single_ones(spark, encoded):
    weights = spark.range(DIMENSION).select(
        F.col("id").alias("idx"), F.array(F.col("id") * 0.1, F.col("id") * -0.2).alias("weights")
    )
    both = {r["model_id"]: r["log_loss"] for r in scoring.evaluate_models(encoded, weights, [0.3, -0.7]).collect()}
    for k, b in enumerate([0.3, -0.7]):
        single = weights.select("idx", F.col("weights")[k].alias("weight"))
        assert both[k] == pytest.approx(scoring.evaluate_model(encoded, single, b).first()["log_loss"], abs=1e-12)


def test_baseline_uses_the_training_rate(encoded):
    rows = encoded.select("split", "label").collect()
    train = [r["label"] for r in rows if r["split"] == "train"]
    rate = sum(train) / len(train)
    for got in scoring.baseline_log_loss(encoded).collect():
        labels = [r["label"] for r in rows if r["split"] == got["split"]]
        expected = sum(-math.log(rate if y == 1 else 1 - rate) for y in labels) / len(labels)
        assert got["class_rate"] == pytest.approx(rate)
        assert got["log_loss"] == pytest.approx(expected)


def test_baseline_of_one_class(spark):
    rows = spark.createDataFrame([("train", 0.0)] * 3 + [("test", 1.0)], "split string, label double")
    losses = {r["split"]: r["log_loss"] for r in scoring.baseline_log_loss(rows).collect()}
    assert losses["train"] == pytest.approx(1.00000008275e-11)
    assert losses["test"] == pytest.approx(25.3284360229)


def _scored(spark, rows):
    return spark.createDataFrame(rows, "obs_id bigint, label double, p double")


def test_roc_with_ties(spark):
    scored = _scored(spark, [(1, 1.0, 0.9), (2, 0.0, 0.5), (3, 1.0, 0.5), (4, 0.0, 0.1)])
    curve = [(r["threshold"], r["tpr"], r["fpr"]) for r in roc.roc_curve(scored).orderBy(F.desc("threshold")).collect()]
    assert curve == [(0.9, 0.5, 0.0), (0.5, 1.0, 0.5), (0.1, 1.0, 1.0)]
    points = [(r["obs_id"], r["tpr"], r["fpr"]) for r in roc.roc_points(scored).orderBy("rank").collect()]
    assert points == [(1, 0.5, 0.0), (2, 0.5, 0.5), (3, 1.0, 0.5), (4, 1.0, 1.0)]


def test_roc_is_monotone_and_ends_at_one(spark, encoded):
    scored = scoring.predict_proba(encoded, _fixed(spark), 0.0)
    curve = roc.roc_curve(scored).orderBy(F.desc("threshold")).collect()
    for name in ("tpr", "fpr"):
        values = [r[name] for r in curve]
        assert values == sorted(values) and values[-1] == 1.0


def test_roc_of_one_class(spark):
    curve = roc.roc_curve(_scored(spark, [(1, 0.0, 0.2), (2, 0.0, 0.4)])).collect()
    assert all(r["tpr"] is None for r in curve) and max(r["fpr"] for r in curve) == 1.0


def test_smallest_weights(spark):
    weights = spark.createDataFrame([(0, 0.5), (1, -0.2), (2, -0.2), (3, -1.0)], "idx bigint, weight double")
    assert [r["idx"] for r in scoring.smallest_weights(weights, 3).collect()] == [3, 1, 2]


def test_first_of_equal_cells_wins(spark):
    cells = spark.createDataFrame(
        [(0, 1.0, 1e-6, 0.5), (1, 1.0, 1e-3, 0.4), (2, 10.0, 1e-6, 0.4), (3, 10.0, 1e-3, float("nan"))],
        "grid_order int, step_size double, reg_param double, log_loss double",
    )
    assert grid.grid_best(cells).first()["grid_order"] == 1
    matrix = {r["step_size"]: (r["reg_0"], r["reg_1"]) for r in grid.grid_matrix(cells, [1e-6, 1e-3]).collect()}
    assert matrix[1.0] == (0.5, 0.4) and matrix[10.0][0] == 0.4


def test_roc_shuffles_rows_once(spark, encoded):
    """Ranges are summed where they are: after the range exchange no row moves again."""
    scored = scoring.predict_proba(encoded, _fixed(spark), 0.0)
    points = _executed(roc.roc_points(scored).drop("tpr", "fpr"))
    assert "Exchange" not in points and "Window" not in points


def test_trained_report(encoded):
    table = {r["split"]: r for r in model_report(encoded, DIMENSION, Setting(10.0, 1e-6), 20).collect()}
    scored = trained_scores(encoded, DIMENSION, Setting(10.0, 1e-6), 20).where("split = 'train'").collect()
    assert table["train"]["sum_p"] == pytest.approx(sum(r["p"] for r in scored))
    assert table["train"]["log_loss"] < table["train"]["baseline_log_loss"]


def test_report(encoded):
    table = {r["split"]: r for r in report(encoded, DIMENSION, iterations=20).collect()}
    assert set(table) == {"train", "validation", "test"}
    assert table["train"]["log_loss"] < table["train"]["baseline_log_loss"]


def test_vectors_feed_spark_ml(encoded):
    from pyspark.ml.classification import LogisticRegression

    from clickweave.operators.vectors import to_vectors

    vectors = to_vectors(encoded, DIMENSION)
    row = vectors.orderBy("obs_id").first()
    assert row["features"].size == DIMENSION and len(row["features"].indices) == 0
    model = LogisticRegression(maxIter=2).fit(vectors)
    assert model.coefficients.size == DIMENSION
