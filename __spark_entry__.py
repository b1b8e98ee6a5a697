"""

``queries()[name](spark, sf_dir)`` builds a DataFrame with the library;
``oracle_sql()[name]`` is the equivalent DuckDB SQL over the same tables.
Floating-point results are rounded to six digits on both sides, because the
two engines add in different orders.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clickweave.functions.scalar import fixed_text, scientific_text
from clickweave.operators import (
    descent,
    grid,
    hashed,
    mlencode,
    observations,
    onehot,
    profile,
    roc,
    scoring,
    splits,
    vectors,
)
from clickweave.plans.scratch import scratch_path
from clickweave.sources import derived, lines, store
from clickweave.workflow import model_report, report, trained_scores
from oracle_queries import ORACLES

# the text operators are an optional part: everything else works without them
try:
    import corpus_pipeline
    from clickweave.llm import queries as text_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("clickweave.llm", "corpus_pipeline"):
        raise
    corpus_pipeline = text_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

DIGITS = 6
# scores are rounded before they are compared, so that ties are ties in both engines
SCORE_DIGITS = 9
INTERCEPT = -1.0
PREVIEW_ROWS = 5
LOAD_PARTITIONS = 4
FIRST_ROWS = 20
SMALLEST = 5
FIT = descent.Setting(step_size=10.0, reg_param=1e-6)
SPARSE = descent.Setting(step_size=10.0, reg_param=1e-3, reg_type="l1")
FREE = descent.Setting(step_size=10.0, reg_param=1e-6, reg_type=None)
HALF = descent.Batches(fraction=0.5)
FIT_ITERATIONS, SHORT_ITERATIONS, BATCH_ITERATIONS = 50, 20, 10
MATRIX_STEPS = [3.0, 6.0, 9.0, 12.0, 15.0, 18.0]
MATRIX_ITERATIONS = 3
MATRIX_REGS = [1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2]

SOURCES = {"events": derived.ctr_events, "orders": derived.ctr_orders, "documents": derived.ctr_documents}


# ------------------------------------------------------------------ shared inputs


def _lines(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    return lines.normalize_lines(SOURCES[source](spark, sf_dir))


def _observations(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """Parsed observations with their split."""
    return observations.parse_observations(splits.hash_split(_lines(spark, sf_dir, source)))


def _of(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("split").isin(*names))


def _dictionary(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    return onehot.fit_dictionary(_of(_observations(spark, sf_dir, source), "train"))


def _ohe(spark: SparkSession, sf_dir: str, source: str = "events") -> tuple[DataFrame, DataFrame]:
    """All rows encoded with the training dictionary, and that dictionary."""
    dictionary = _dictionary(spark, sf_dir, source)
    return onehot.encode_ohe(_observations(spark, sf_dir, source), dictionary), dictionary


def _hashed(spark: SparkSession, sf_dir: str, source: str = "events", buckets: int = hashed.NUM_BUCKETS) -> DataFrame:
    return hashed.encode_hashed(_observations(spark, sf_dir, source), buckets)


def _weight(idx: Column, model_id: int = 0) -> Column:
    """Fixed pseudo-random weights, to check scoring without training."""
    return ((idx * 7919 + model_id * 104729) % 1000) / F.lit(1000.0) - F.lit(0.5)


def _fixed_model(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("idx", _weight(F.col("idx")).alias("weight"))


def _fixed_models(dictionary: DataFrame, n: int) -> DataFrame:
    return dictionary.select("idx", F.array(*[_weight(F.col("idx"), k) for k in range(n)]).alias("weights"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded, dictionary = _ohe(spark, sf_dir)
    return scoring.predict_proba(encoded, _fixed_model(dictionary), INTERCEPT)


def _ranked_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).withColumn("p", F.round("p", SCORE_DIGITS))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# ------------------------------------------------------------------ queries


def q_load_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip through gzip text files, as the loader meets them."""
    folder = scratch_path(spark, "text")
    derived.ctr_events(spark, sf_dir).select("line").write.option("compression", "gzip").text(folder)
    return lines.load_lines(spark, folder).select("line")


def q_load_lines_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every loaded line has an id of its own."""
    folder = scratch_path(spark, "text")
    derived.ctr_events(spark, sf_dir).select("line").write.option("compression", "gzip").text(folder)
    loaded = lines.load_lines(spark, folder)
    return loaded.agg(F.count("*").alias("n_lines"), F.countDistinct("obs_id").alias("n_ids"))


def q_load_lines_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gzip stream, read by several even tasks afterwards, each line under an id of its own."""
    folder = scratch_path(spark, "text")
    one = derived.ctr_events(spark, sf_dir).select("line").coalesce(1)
    one.write.option("compression", "gzip").text(folder)
    loaded = lines.load_lines(spark, folder, min_partitions=LOAD_PARTITIONS)
    shares = loaded.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("n"), F.countDistinct("obs_id").alias("ids")
    )
    return shares.agg(
        F.sum("n").alias("n_lines"),
        F.sum("ids").alias("n_ids"),
        (F.count("*") >= LOAD_PARTITIONS).alias("enough"),
        (F.max("n") <= 2 * F.min("n")).alias("even"),
    )


def q_normalize_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


def q_preview_k(spark, sf_dir):
    return lines.preview(_lines(spark, sf_dir), PREVIEW_ROWS)


def q_row_count_check(spark, sf_dir):
    """Lines that came back from text files against the rows of the table they were made of."""
    expected = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    return lines.row_count_check(q_load_lines(spark, sf_dir), expected)


def _q_parse(source):
    def query(spark, sf_dir):
        parsed = observations.parse_observations(_lines(spark, sf_dir, source))
        return parsed.select(
            "obs_id", "label", F.size("feats").alias("n_feats"), F.concat_ws("|", "feats").alias("feats")
        )

    return query


def _q_explode(source):
    return lambda spark, sf_dir: observations.explode_features(
        observations.parse_observations(_lines(spark, sf_dir, source))
    )


def q_hash_split(spark, sf_dir):
    return splits.hash_split(_lines(spark, sf_dir)).select("obs_id", "split")


def q_random_split(spark, sf_dir):
    parts = splits.random_split(_lines(spark, sf_dir))
    labelled = [part.select("obs_id", F.lit(name).alias("split")) for name, part in parts.items()]
    ids = labelled[0].unionByName(labelled[1]).unionByName(labelled[2])
    per_id = ids.groupBy("obs_id").agg(F.countDistinct("split").alias("parts"), F.count("*").alias("n"))
    covered = per_id.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_ids"),
        F.sum((F.col("parts") > 1).cast("bigint")).alias("n_shared"),
    )
    # a part of n rows drawn with chance w has n w rows, give or take sqrt(n w (1 - w))
    total = F.sum("n").over(Window.partitionBy())
    sizes = splits.split_counts(ids).withColumn("total", total)
    off = F.lit(False)
    for name, weight in zip(splits.SPLITS, splits.WEIGHTS):
        spread = 5 * F.sqrt(F.col("total") * weight * (1 - weight))
        off |= (F.col("split") == name) & (F.abs(F.col("n") - F.col("total") * weight) > spread)
    return covered.withColumn("sizes_ok", sizes.agg((~F.bool_or(off)).alias("ok")).scalar())


def q_split_counts(spark, sf_dir):
    return splits.split_counts(splits.hash_split(_lines(spark, sf_dir)))


def q_cached_splits(spark, sf_dir):
    with splits.CachedSplits(_observations(spark, sf_dir)) as parts:
        counted = parts.counts().collect()
    return spark.createDataFrame(counted, "split string, n bigint, is_cached boolean")


def q_encoded_store(spark, sf_dir):
    """Encoded rows written by split and bucket, and read again."""
    table = store.write_encoded(_ohe(spark, sf_dir)[0])
    return profile.explode_encoded(store.read_encoded(spark, table)).select("obs_id", "split", "idx", "val")


def q_encoded_store_join(spark, sf_dir):
    """Two stored encodings of the validation rows side by side, joined bucket by bucket."""
    sides = []
    for name, encoded in (("ohe", _ohe(spark, sf_dir)[0]), ("hashed", _hashed(spark, sf_dir))):
        rows = store.read_encoded(spark, store.write_encoded(encoded), "validation")
        sides.append(rows.select("obs_id", F.size("indices").alias(f"nnz_{name}")))
    return sides[0].join(sides[1], "obs_id")


def _q_categories(source):
    return lambda spark, sf_dir: profile.categories_per_feature(
        observations.explode_features(_observations(spark, sf_dir, source))
    )


def q_categories_documents(spark, sf_dir):
    parsed = observations.parse_observations(lines.normalize_lines(derived.document_features(spark, sf_dir)))
    return profile.categories_per_feature(observations.explode_features(parsed))


def q_ohe_dictionary(spark, sf_dir):
    return _dictionary(spark, sf_dir).select("feature_id", "value", "idx")


def _q_dimension(source):
    return lambda spark, sf_dir: onehot.dictionary_size(_dictionary(spark, sf_dir, source))


def _q_encode_ohe(source):
    return lambda spark, sf_dir: profile.explode_encoded(_ohe(spark, sf_dir, source)[0]).select("obs_id", "idx", "val")


def _q_encode_ohe_ml(*names):
    """As encode_ohe, by pyspark.ml stages; rows of the given splits, or all."""

    def query(spark, sf_dir):
        rows = _observations(spark, sf_dir)
        model = mlencode.fit_ml_encoder(_of(rows, "train"))
        encoded = vectors.from_vectors(mlencode.encode_ml(_of(rows, *names) if names else rows, model))
        return profile.explode_encoded(encoded).select("obs_id", "idx", "val")

    return query


def q_encode_ohe_unseen(spark, sf_dir):
    rest = _of(_observations(spark, sf_dir, "orders"), "validation", "test")
    encoded = onehot.encode_ohe(rest, _dictionary(spark, sf_dir, "orders"))
    return profile.explode_encoded(encoded).select("obs_id", "split", "idx", "val")


def q_encode_ohe_shuffled(spark, sf_dir):
    """As encode_ohe_orders, as if no dictionary were small enough to broadcast."""
    dictionary = _dictionary(spark, sf_dir, "orders")
    encoded = onehot.encode_ohe(_observations(spark, sf_dir, "orders"), dictionary, broadcast_bytes=0)
    return profile.explode_encoded(encoded).select("obs_id", "idx", "val")


def q_unseen_features_shuffled(spark, sf_dir):
    rows, dictionary = _observations(spark, sf_dir, "orders"), _dictionary(spark, sf_dir, "orders")
    return onehot.unseen_features(rows, dictionary, broadcast_bytes=0).select("obs_id", "feature_id", "value")


def q_unseen_features(spark, sf_dir):
    unseen = onehot.unseen_features(_observations(spark, sf_dir, "orders"), _dictionary(spark, sf_dir, "orders"))
    return unseen.select("obs_id", "feature_id", "value")


def q_nnz_per_row(spark, sf_dir):
    return profile.nnz_per_row(_ohe(spark, sf_dir, "orders")[0])


def q_total_nnz(spark, sf_dir):
    return profile.total_nnz(_ohe(spark, sf_dir, "orders")[0], ["split"])


def q_feature_frequency(spark, sf_dir):
    return profile.feature_frequency(_of(_ohe(spark, sf_dir)[0], "train"))


def q_feature_frequency_hashed(spark, sf_dir):
    return profile.feature_frequency(_hashed(spark, sf_dir))


def q_frequency_histogram(spark, sf_dir):
    return profile.frequency_histogram(q_feature_frequency(spark, sf_dir))


def q_frequency_histogram_log(spark, sf_dir):
    return _rounded(
        profile.frequency_histogram_log(q_frequency_histogram(spark, sf_dir)), "ln_bucket", "ln_features"
    )


def q_sparsity(spark, sf_dir):
    encoded, dictionary = _ohe(spark, sf_dir)
    dimension = onehot.dictionary_size(dictionary).scalar()
    ohe = profile.sparsity(_of(encoded, "train"), dimension).select(F.lit("ohe").alias("encoding"), "sparsity")
    hash_rows = profile.sparsity(_of(_hashed(spark, sf_dir), "train"), hashed.NUM_BUCKETS)
    both = ohe.unionByName(hash_rows.select(F.lit("hashed").alias("encoding"), "sparsity"))
    return both.withColumn("sparsity", F.round("sparsity", 9))


def q_metric_formats(spark, sf_dir):
    """Metrics as they are shown: losses with three decimals, sparsities in scientific notation."""
    losses = scoring.baseline_log_loss(_observations(spark, sf_dir)).select(
        F.concat(F.lit("baseline "), "split").alias("metric"), fixed_text(F.col("log_loss")).alias("text")
    )
    sparsities = q_sparsity(spark, sf_dir).select(
        F.concat(F.lit("sparsity "), "encoding").alias("metric"), scientific_text(F.col("sparsity")).alias("text")
    )
    return losses.unionByName(sparsities)


def q_first_k_sum(spark, sf_dir):
    encoded = _hashed(spark, sf_dir)
    amounts = {"nnz": profile.nnz().cast("bigint"), "label": F.col("label")}
    sums = [
        profile.first_k_sum(encoded, amount.cast("double"), FIRST_ROWS).select(F.lit(what).alias("what"), "total")
        for what, amount in amounts.items()
    ]
    return sums[0].unionByName(sums[1])


def q_row_logloss(spark, sf_dir):
    scored = scoring.row_log_loss(_scored(spark, sf_dir))
    return _rounded(scored.select("obs_id", "label", "log_loss"), "log_loss")


def _q_class_rate(source):
    return lambda spark, sf_dir: _rounded(
        profile.class_rate(_of(_observations(spark, sf_dir, source), "train")), "class_rate"
    )


def _q_baseline(source):
    return lambda spark, sf_dir: _rounded(
        scoring.baseline_log_loss(_observations(spark, sf_dir, source)), "class_rate", "log_loss"
    )


def _q_hash_bucket(source, buckets):
    def query(spark, sf_dir):
        features = observations.explode_features(_observations(spark, sf_dir, source))
        return hashed.hash_buckets(features, buckets).select("obs_id", "feature_id", "feature", "bucket")

    return query


def _q_encode_hashed(source, buckets):
    return lambda spark, sf_dir: profile.explode_encoded(_hashed(spark, sf_dir, source, buckets)).select(
        "obs_id", "idx", "val"
    )


def q_predict_proba(spark, sf_dir):
    return _rounded(_scored(spark, sf_dir).select("obs_id", "label", "p"), "p")


def q_predict_proba_shuffled(spark, sf_dir):
    encoded, dictionary = _ohe(spark, sf_dir)
    scored = scoring.predict_proba(encoded, _fixed_model(dictionary), INTERCEPT, broadcast_bytes=0)
    return _rounded(scored.select("obs_id", "label", "p"), "p")


def q_predict_proba_hashed(spark, sf_dir):
    weights = spark.range(hashed.NUM_BUCKETS).select(F.col("id").alias("idx"), _weight(F.col("id")).alias("weight"))
    scored = scoring.predict_proba(_hashed(spark, sf_dir, "orders"), weights, INTERCEPT)
    return _rounded(scored.select("obs_id", "label", "p"), "p")


def q_predict_proba_ml(spark, sf_dir):
    """As predict_proba, by a pyspark.ml model that was given the weights."""
    encoded, dictionary = _ohe(spark, sf_dir)
    dimension = dictionary.count()
    model = vectors.to_ml_model(_fixed_model(dictionary), INTERCEPT, dimension)
    scored = model.transform(vectors.to_vectors(encoded, dimension))
    return _rounded(scored.select("obs_id", "label", vectors.positive_probability().alias("p")), "p")


def q_prediction_sum(spark, sf_dir):
    return _rounded(scoring.prediction_sum(_scored(spark, sf_dir)), "sum_p")


def q_evaluate_logloss(spark, sf_dir):
    encoded, dictionary = _ohe(spark, sf_dir)
    return _rounded(scoring.evaluate_model(encoded, _fixed_model(dictionary), INTERCEPT, ["split"]), "log_loss")


def q_bottom_k_weights(spark, sf_dir):
    return _rounded(scoring.smallest_weights(_fixed_model(_dictionary(spark, sf_dir)), SMALLEST), "weight")


def q_roc_points_by_row(spark, sf_dir):
    return _rounded(roc.roc_points(_ranked_input(spark, sf_dir)), "tpr", "fpr")


def q_roc_curve(spark, sf_dir):
    return _rounded(roc.roc_curve(_ranked_input(spark, sf_dir)), "tpr", "fpr")


def _q_fit(iterations, tol=descent.TOLERANCE, setting=FIT, **options):
    """Weights of one model fitted on the one-hot training rows, the intercept under an index of its own."""

    def query(spark, sf_dir):
        encoded, dictionary = _ohe(spark, sf_dir)
        fitted = descent.fit_sgd(
            _of(encoded, "train"), dictionary.count(), [setting], iterations, tol, **options
        )
        if not options.get("intercept", True):
            return _rounded(fitted.model(), "weight")
        bias = spark.createDataFrame([(descent.BIAS_INDEX, fitted.intercepts[0])], "idx bigint, weight double")
        return _rounded(fitted.model().unionByName(bias), "weight")

    return query


def _q_gd(iterations, **options):
    """The all-DataFrame path, with every step run."""
    return _q_fit(iterations, 0.0, broadcast_parameters=0, **options)


def _grid_fixed(spark, sf_dir, settings):
    encoded, dictionary = _ohe(spark, sf_dir)
    n = len(settings)
    return grid.grid_evaluate(
        _of(encoded, "validation"), _fixed_models(dictionary, n), [INTERCEPT] * n, settings
    )


def q_grid_evaluate(spark, sf_dir):
    return _rounded(_grid_fixed(spark, sf_dir, grid.grid_settings()), "log_loss")


def q_grid_best(spark, sf_dir):
    return _rounded(grid.grid_best(_grid_fixed(spark, sf_dir, grid.grid_settings())), "log_loss")


def q_grid_matrix(spark, sf_dir):
    cells = _grid_fixed(spark, sf_dir, grid.grid_settings(MATRIX_STEPS, MATRIX_REGS))
    matrix = grid.grid_matrix(cells, MATRIX_REGS)
    return _rounded(matrix, *[f"reg_{k}" for k in range(len(MATRIX_REGS))])


def q_grid_search(spark, sf_dir):
    encoded = _hashed(spark, sf_dir)
    _, cells = grid.grid_search(_of(encoded, "train"), _of(encoded, "validation"), hashed.NUM_BUCKETS)
    return _rounded(cells, "log_loss")


def q_ohe_report(spark, sf_dir):
    """The one-hot study with a trained model."""
    encoded, dictionary = _ohe(spark, sf_dir)
    found = model_report(encoded, dictionary.count(), FIT, FIT_ITERATIONS)
    return _rounded(found, "log_loss", "baseline_log_loss").withColumn("sum_p", F.round("sum_p", 4))


def q_roc_curve_trained(spark, sf_dir):
    encoded, dictionary = _ohe(spark, sf_dir)
    scored = trained_scores(encoded, dictionary.count(), FIT, FIT_ITERATIONS)
    ranked = _of(scored, "validation").withColumn("p", F.round("p", DIGITS))
    return _rounded(roc.roc_curve(ranked), "tpr", "fpr")


def q_grid_matrix_fitted(spark, sf_dir):
    """All 36 cells fitted in the same passes."""
    encoded = _hashed(spark, sf_dir)
    settings = grid.grid_settings(MATRIX_STEPS, MATRIX_REGS)
    _, cells = grid.grid_search(
        _of(encoded, "train"), _of(encoded, "validation"), hashed.NUM_BUCKETS, settings, MATRIX_ITERATIONS, tol=0.0
    )
    return _rounded(grid.grid_matrix(cells, MATRIX_REGS), *[f"reg_{k}" for k in range(len(MATRIX_REGS))])


def q_model_report(spark, sf_dir):
    return _rounded(report(_hashed(spark, sf_dir), hashed.NUM_BUCKETS), "log_loss", "baseline_log_loss")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | _text_queries()


def _text_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if text_queries is None:
        return {}
    return text_queries.queries() | {"pipeline": corpus_pipeline.run}


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "load_lines": q_load_lines,
        "load_lines_ids": q_load_lines_ids,
        "load_lines_partitions": q_load_lines_partitions,
        "normalize_lines": q_normalize_lines,
        "preview_k": q_preview_k,
        "row_count_check": q_row_count_check,
        "parse_observations": _q_parse("events"),
        "parse_observations_orders": _q_parse("orders"),
        "explode_features": _q_explode("events"),
        "explode_features_orders": _q_explode("orders"),
        "hash_split": q_hash_split,
        "random_split": q_random_split,
        "split_counts": q_split_counts,
        "cached_splits": q_cached_splits,
        "categories_per_feature": _q_categories("events"),
        "categories_per_feature_orders": _q_categories("orders"),
        "categories_per_feature_documents": q_categories_documents,
        "ohe_dictionary": q_ohe_dictionary,
        "ohe_dimension": _q_dimension("events"),
        "ohe_dimension_orders": _q_dimension("orders"),
        "encode_ohe": _q_encode_ohe("events"),
        "encode_ohe_orders": _q_encode_ohe("orders"),
        "encode_ohe_shuffled": q_encode_ohe_shuffled,
        "encode_ohe_unseen": q_encode_ohe_unseen,
        "encode_ohe_ml": _q_encode_ohe_ml(),
        "encode_ohe_ml_unseen": _q_encode_ohe_ml("validation", "test"),
        "encoded_store": q_encoded_store,
        "encoded_store_join": q_encoded_store_join,
        "unseen_features": q_unseen_features,
        "unseen_features_shuffled": q_unseen_features_shuffled,
        "nnz_per_row": q_nnz_per_row,
        "total_nnz": q_total_nnz,
        "feature_frequency": q_feature_frequency,
        "feature_frequency_hashed": q_feature_frequency_hashed,
        "frequency_histogram": q_frequency_histogram,
        "frequency_histogram_log": q_frequency_histogram_log,
        "sparsity": q_sparsity,
        "metric_formats": q_metric_formats,
        "first_k_sum": q_first_k_sum,
        "row_logloss": q_row_logloss,
        "class_rate": _q_class_rate("events"),
        "class_rate_documents": _q_class_rate("documents"),
        "baseline_logloss": _q_baseline("events"),
        "baseline_logloss_orders": _q_baseline("orders"),
        "hash_bucket": _q_hash_bucket("events", 1000003),
        "hash_bucket_orders": _q_hash_bucket("orders", hashed.NUM_BUCKETS),
        "encode_hashed": _q_encode_hashed("events", hashed.NUM_BUCKETS),
        "encode_hashed_orders": _q_encode_hashed("orders", hashed.NUM_BUCKETS),
        "encode_hashed_collisions": _q_encode_hashed("events", 7),
        "predict_proba": q_predict_proba,
        "predict_proba_shuffled": q_predict_proba_shuffled,
        "predict_proba_hashed": q_predict_proba_hashed,
        "predict_proba_ml": q_predict_proba_ml,
        "prediction_sum": q_prediction_sum,
        "evaluate_logloss": q_evaluate_logloss,
        "bottom_k_weights": q_bottom_k_weights,
        "roc_points_by_row": q_roc_points_by_row,
        "roc_curve": q_roc_curve,
        "roc_curve_trained": q_roc_curve_trained,
        "gd_step_1": _q_gd(1),
        "gd_step_3": _q_gd(3),
        "gd_step_shuffled": _q_gd(2, broadcast_bytes=0),
        "fit_sgd": _q_fit(FIT_ITERATIONS),
        "fit_sgd_l1": _q_fit(SHORT_ITERATIONS, setting=SPARSE),
        "fit_sgd_unregularised": _q_fit(SHORT_ITERATIONS, setting=FREE),
        "fit_sgd_no_intercept": _q_fit(SHORT_ITERATIONS, intercept=False),
        "fit_sgd_batches": _q_fit(BATCH_ITERATIONS, batches=HALF),
        "gd_step_l1_shuffled": _q_gd(2, setting=SPARSE, intercept=False, broadcast_bytes=0),
        "gd_step_batches_shuffled": _q_gd(2, batches=HALF, broadcast_bytes=0),
        "grid_search": q_grid_search,
        "grid_evaluate": q_grid_evaluate,
        "grid_best": q_grid_best,
        "grid_matrix": q_grid_matrix,
        "grid_matrix_fitted": q_grid_matrix_fitted,
        "model_report": q_model_report,
        "ohe_report": q_ohe_report,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query, for those that SQL can express."""
    if text_queries is None:
        return dict(ORACLES)
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLES | text_queries.oracle_sql() | pipeline


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: search the grid on hashed features, report the best model against the baseline."""
    return q_model_report(spark, SMOKE_DIR)
