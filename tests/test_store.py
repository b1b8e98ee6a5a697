"""Stored encodings and cached splits."""

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from clickweave.operators import splits
from clickweave.sources import store

SCHEMA = "obs_id bigint, split string, label double, indices array<bigint>, values array<double>"


@pytest.fixture(scope="module")
def encoded(spark):
    data = [
        (i, splits.SPLITS[i % 3 if i % 5 else 0], float(i % 2), [i % 7, 10], [1.0, 2.0]) if i % 11 else
        (i, "train", 0.0, [], [])
        for i in range(300)
    ]
    # equal rows, and a row without an id
    data += [data[3], data[3], (None, "test", 1.0, [1], [1.0])]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def table(spark, encoded):
    name = store.write_encoded(encoded, buckets=4)
    yield name
    store.drop_encoded(spark, name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.select("obs_id", "split", "label", "indices", "values").collect()), key=repr)


def test_round_trip(spark, encoded, table):
    assert rows(store.read_encoded(spark, table)) == rows(encoded)
    for name in splits.SPLITS:
        assert rows(store.read_encoded(spark, table, name)) == rows(encoded.where(F.col("split") == name))


def test_one_file_per_bucket_and_split(spark, table):
    files = store.read_encoded(spark, table).inputFiles()
    assert len(files) <= 4 * len(splits.SPLITS)


def test_a_split_is_read_alone(spark, table):
    text = plan(store.read_encoded(spark, table, "test"))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert filters and all("split" in line.split("PartitionFilters:")[1].split("]")[0] for line in filters)
    assert all("split=test" in f for f in store.read_encoded(spark, table, "test").inputFiles())


def test_join_and_grouping_by_id_move_nothing(spark, encoded, table):
    other = store.write_encoded(encoded.withColumn("label", F.lit(1.0)), buckets=4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for key in before:
            spark.conf.set(key, {"spark.sql.autoBroadcastJoinThreshold": "-1"}.get(key, "false"))
        one = store.read_encoded(spark, table, "train")
        both = one.join(store.read_encoded(spark, other, "train").select("obs_id", F.col("label").alias("l2")), "obs_id")
        assert "Exchange" not in plan(both)
        expected = encoded.where("split = 'train'").groupBy("obs_id").count()
        assert both.count() == expected.agg(F.sum(F.col("count") * F.col("count"))).first()[0]
        assert "Exchange" not in plan(one.groupBy("obs_id").count())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        store.drop_encoded(spark, other)


def test_another_session_opens_the_folder(spark, encoded, tmp_path):
    first = store.write_encoded(encoded, f"{tmp_path}/enc", buckets=3)
    store.drop_encoded(spark, first)
    opened = store.open_encoded(spark, f"{tmp_path}/enc", SCHEMA, buckets=3)
    try:
        assert rows(store.read_encoded(spark, opened)) == rows(encoded)
        assert "Exchange" not in plan(store.read_encoded(spark, opened, "test").groupBy("obs_id").count())
    finally:
        store.drop_encoded(spark, opened)


def test_what_cannot_be_stored(spark, encoded, table):
    with pytest.raises(ValueError, match="split"):
        store.write_encoded(encoded.drop("split"))
    with pytest.raises(Exception, match="already exists"):
        store.write_encoded(encoded, table=table)


def test_nothing_to_store(spark, encoded):
    name = store.write_encoded(encoded.limit(0))
    assert store.read_encoded(spark, name).count() == 0
    store.drop_encoded(spark, name)


# ------------------------------------------------------------------ cached splits


@pytest.fixture
def source(spark, encoded, tmp_path):
    path = f"{tmp_path}/rows"
    encoded.write.parquet(path)
    return spark.read.parquet(path)


def test_second_use_does_not_read_the_source(spark, source):
    """How often the rows are computed is counted while they are."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = source.mapInArrow(count, source.schema)
    with splits.CachedSplits(counted) as parts:
        first = {r.split: r.n for r in parts.counts().collect()}
        assert first == {r.split: r.n for r in splits.split_counts(source).collect()}
        computed = seen.value
        assert computed == 303
        assert rows(parts["train"]) == rows(source.where("split = 'train'"))
        assert parts["test"].count() + parts["validation"].count() + parts["train"].count() == 303
        assert seen.value == computed
        assert "FileScan" not in plan(parts["test"]).split("InMemoryRelation")[0]


def test_what_is_cached_can_be_asked(spark, source):
    parts = splits.CachedSplits(source, level=StorageLevel.DISK_ONLY)
    assert all(parts.is_cached(name) for name in splits.SPLITS)
    assert [(r.split, r.is_cached) for r in parts.counts().collect()] == [(n, True) for n in splits.SPLITS]
    assert parts.rows.storageLevel == StorageLevel.DISK_ONLY
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    parts.release()
    parts.release()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before - 1
    assert not any(parts.is_cached(name) for name in splits.SPLITS)
    with pytest.raises(RuntimeError, match="released"):
        parts["train"]


def test_all_are_released_after_an_error(spark, source):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    with pytest.raises(ZeroDivisionError):
        with splits.CachedSplits(source) as parts:
            parts.counts().collect()
            assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before + 1
            1 / 0
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_splits_without_rows_and_unknown_ones(source):
    with splits.CachedSplits(source.where("split = 'test'")) as parts:
        assert [(r.split, r.n > 0) for r in parts.counts().collect()] == [
            ("train", False), ("validation", False), ("test", True)
        ]
        assert parts["train"].count() == 0
        with pytest.raises(KeyError):
            parts["dev"]
