import pytest
from pyspark.sql import functions as F

from clickweave.operators import onehot, profile
from clickweave.operators.observations import parse_observations
from clickweave.plans import lookup


def _observations(spark, *texts):
    lines = spark.createDataFrame(list(enumerate(texts)), "obs_id bigint, line string")
    return parse_observations(lines)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value; others are spread out; one column may be empty."""
    ids = spark.range(3000)
    feats = F.array(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))),
        F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.lit("x")),
        (F.col("id") % 17).cast("string"),
    )
    return ids.select(F.col("id").alias("obs_id"), (F.col("id") % 2).cast("double").alias("label"), feats.alias("feats"))


def test_dictionary_is_an_ordered_bijection(spark, skewed):
    rows = onehot.fit_dictionary(skewed).collect()
    keys = sorted((r["feature_id"], r["value"]) for r in rows)
    assert {(r["feature_id"], r["value"]): r["idx"] for r in rows} == {k: i for i, k in enumerate(keys)}
    assert (1, "") in keys
    assert {r["n"] for r in rows if r["value"] == "hot"} == {1000}


def test_unseen_values_are_dropped_but_rows_stay(spark):
    train = _observations(spark, "0,a,x", "1,b,", "1,a,x")
    dictionary = onehot.fit_dictionary(train)
    other = _observations(spark, "1,a,x", "0,zzz,yyy", "1", "0,x,a", "1,b,,extra")
    expected = {0: [0, 3], 1: [], 2: [], 3: [], 4: [1, 2]}
    # per position, per feature with broadcast, and shuffled with hot keys
    for options in ({}, {"broadcast_bytes": 0}):
        encoded = {r["obs_id"]: r for r in onehot.encode_ohe(other, dictionary, **options).collect()}
        assert {k: r["indices"] for k, r in encoded.items()} == expected
        assert all(r["values"] == [1.0] * len(r["indices"]) for r in encoded.values())
        assert encoded[1]["label"] == 0.0
        unseen = onehot.unseen_features(other, dictionary, **options).collect()
        assert {(r["obs_id"], r["feature_id"], r["value"]) for r in unseen} == {
            (1, 0, "zzz"), (1, 1, "yyy"), (3, 0, "x"), (3, 1, "a"), (4, 2, "extra"),
        }


def test_all_encoding_paths_agree_under_skew(spark, skewed, monkeypatch):
    # the hot value is unknown to the dictionary in the second round
    for known in ("obs_id % 5 <> 0", "obs_id % 3 <> 0"):
        dictionary = onehot.fit_dictionary(skewed.where(known))

        def encoded(limit=onehot.BROADCAST_BYTES, joins=64):
            monkeypatch.setattr(onehot, "MAX_POSITION_JOINS", joins)
            rows = onehot.encode_ohe(skewed, dictionary, limit).collect()
            return {r["obs_id"]: (r["label"], r["indices"], r["values"]) for r in rows}

        in_place = encoded()
        assert len(in_place) == 3000
        # one position in place and the others by broadcast; by shuffle; nothing in place; everything by shuffle
        assert encoded(joins=1) == in_place
        assert encoded(limit=3000) == in_place
        assert encoded(joins=0) == in_place
        assert encoded(limit=0) == in_place


def test_small_dictionary_needs_no_shuffle(spark, skewed):
    dictionary = onehot.fit_dictionary(skewed)
    plan = onehot.encode_ohe(skewed, dictionary)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_hot_rows_spread_in_the_shuffled_lookup(spark, skewed):
    from clickweave.operators.observations import explode_features
    from clickweave.plans.lookup import hot_keys, left_lookup

    keys = ["feature_id", "value"]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dictionary = onehot.fit_dictionary(skewed)
        # the hot value itself is unknown to the table
        table = dictionary.where("value <> 'hot'")
        single = explode_features(skewed).where("feature_id = 0")
        hot = hot_keys(single, keys)
        joined = left_lookup(single, table, keys, ["idx"], small=False, hot=hot)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 3000 and max(sizes) < 2 * 3000 / 8
        assert joined.where("value = 'hot' and idx is null").count() == 1000
        assert joined.where("idx is not null").count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_training_rows_keep_every_feature(spark, skewed):
    dictionary = onehot.fit_dictionary(skewed)
    encoded = onehot.encode_ohe(skewed, dictionary)
    assert {r["nnz"] for r in profile.nnz_per_row(encoded).collect()} == {3}
    assert profile.total_nnz(encoded).first()[0] == 9000
    d = dictionary.count()
    assert profile.sparsity(encoded, d).first()[0] == pytest.approx(3 / d)
    frequency = profile.feature_frequency(encoded)
    assert frequency.agg(F.sum("n")).first()[0] == 9000
    histogram = {r["bucket"]: r["n_features"] for r in profile.frequency_histogram(frequency).collect()}
    # 2000 single values, 17 remainders in 129..256, the hot value in 513..1024, '' and 'x' above 1024
    assert histogram == {1: 2000, 256: 17, 1024: 1}


def test_first_k_sum_follows_the_key(spark, skewed):
    total = profile.first_k_sum(skewed.repartition(7), F.col("label"), 10).first()[0]
    assert total == 5.0


def test_equal_observations_stay_apart_on_all_paths(spark, monkeypatch):
    rows = [(7, 1.0, ["a", "c"])] * 2 + [(7, 1.0, ["b", "d"]), (8, 0.0, [])]
    observed = spark.createDataFrame(rows, "obs_id bigint, label double, feats array<string>")
    dictionary = onehot.fit_dictionary(observed)
    expected = [[], [0, 2], [0, 2], [1, 3]]
    for limit, joins in ((onehot.BROADCAST_BYTES, 64), (onehot.BROADCAST_BYTES, 1), (0, 64)):
        monkeypatch.setattr(onehot, "MAX_POSITION_JOINS", joins)
        encoded = onehot.encode_ohe(observed, dictionary, limit).collect()
        assert sorted(r["indices"] for r in encoded) == expected


def test_a_long_hot_key_is_spread(spark):
    """A key of many bytes that a third of all rows hold is nobody's whole task."""
    from clickweave.plans.lookup import hot_keys, left_lookup

    text = F.when(F.col("id") % 3 == 0, F.repeat(F.lit("x"), 5000)).otherwise(F.col("id").cast("string"))
    rows = spark.range(6000).select(F.col("id").alias("obs_id"), text.alias("value"))
    table = rows.select("value").distinct().withColumn("idx", F.length("value"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = left_lookup(rows, table, ["value"], ["idx"], small=False, hot=hot_keys(rows, ["value"]))
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 6000 and max(sizes) < 2 * 6000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert joined.where("idx = 5000").count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hashed_encoding_reads_each_digest_once(spark, skewed):
    from clickweave.operators.hashed import encode_hashed

    plan = encode_hashed(skewed, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1


def test_total_nnz_by_group(spark, skewed):
    encoded = onehot.encode_ohe(skewed, onehot.fit_dictionary(skewed))
    assert {r["label"]: r["total_nnz"] for r in profile.total_nnz(encoded, ["label"]).collect()} == {0.0: 4500, 1.0: 4500}


def test_hot_keys_are_counted_in_one_pass(spark, tmp_path):
    """What steers the salting costs one scan of the rows."""
    rows = spark.range(0, 4000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    hot = lookup.hot_keys(rows.mapInArrow(count, "k bigint"), ["k"])
    assert hot.count() == 1 and seen.value == 4000
    assert lookup.hot_keys(rows.limit(0), ["k"]).count() == 0
    assert lookup.hot_keys(rows.select(F.lit(None).cast("bigint").alias("k")), ["k"]).count() == 0
