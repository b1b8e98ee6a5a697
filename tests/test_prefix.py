import random

import pytest
from pyspark.sql import functions as F

from clickweave.plans.prefix import dense_index, running_totals


@pytest.fixture(params=["true", "false"])
def adaptive(spark, request):
    """Without adaptive planning the ranges are not merged, so several are used."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_dense_index(spark, adaptive):
    keys = [(i % 3, f"k{i * 7919 % 5000}") for i in range(4000)]
    random.Random(1).shuffle(keys)
    rows = spark.createDataFrame(keys, "a int, b string").distinct().repartition(9)
    got = {(r["a"], r["b"]): r["idx"] for r in dense_index(rows, ["a", "b"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(set(keys)))}


def test_running_totals(spark, adaptive):
    values = [(i, (i * 31) % 97, float(i % 2)) for i in range(3000)]
    rows = spark.createDataFrame(values, "id bigint, score int, y double").withColumn("one", F.lit(1))
    ranked = running_totals(rows.repartition(7), [F.desc("score"), F.asc("id")], {"rank": "one", "tp": "y"})
    tp = 0.0
    got = {r["id"]: (r["rank"], r["tp"]) for r in ranked.collect()}
    for rank, (i, _, y) in enumerate(sorted(values, key=lambda v: (-v[1], v[0])), start=1):
        tp += y
        assert got[i] == (rank, tp)


def test_empty_input(spark):
    assert dense_index(spark.createDataFrame([], "a int"), ["a"]).count() == 0
