import hashlib
import math

import pytest
from pyspark.sql import functions as F

from clickweave.functions.hashing import md5_mod
from clickweave.functions.scalar import fixed_text, log_loss, pow2_bucket, probability, scientific_text
from clickweave.operators.hashed import encode_hashed
from clickweave.operators.observations import parse_observations


@pytest.mark.parametrize(
    "p, y, expected",
    [
        (0.5, 1, 0.69314718056),
        (0.01, 0, 0.0100503358535),
        (0.01, 1, 4.60517018599),
        (0.0, 1, 25.3284360229),
        (1.0, 1, 1.00000008275e-11),
        (1.0, 0, 25.3284360229),
    ],
)
def test_log_loss(spark, p, y, expected):
    got = spark.createDataFrame([(p, float(y))], "p double, y double").select(log_loss(F.col("p"), F.col("y")))
    assert got.first()[0] == pytest.approx(expected, rel=1e-8)


def test_log_loss_nudges_only_exact_ends(spark):
    rows = spark.createDataFrame([(1e-13, 1.0)], "p double, y double")
    assert rows.select(log_loss(F.col("p"), F.col("y"))).first()[0] == pytest.approx(-math.log(1e-13))


def test_probability_is_bounded(spark):
    rows = spark.createDataFrame([(0, -900.0), (1, 0.0), (2, 900.0), (3, 1.5)], "i int, m double")
    low, mid, high, some = [r[0] for r in rows.orderBy("i").select(probability(F.col("m"))).collect()]
    assert mid == 0.5
    assert low == pytest.approx(1 / (1 + math.exp(20)))
    assert high == pytest.approx(1 / (1 + math.exp(-20)))
    assert some == pytest.approx(1 / (1 + math.exp(-1.5)))


def test_pow2_bucket(spark):
    cases = {0: 1, 1: 1, 2: 2, 3: 4, 4: 4, 5: 8, 513: 1024, 1024: 1024, 1025: -1, 10**9: -1}
    rows = spark.createDataFrame([(n,) for n in cases], "n bigint").select("n", pow2_bucket(F.col("n")).alias("b"))
    assert {r["n"]: r["b"] for r in rows.collect()} == cases


@pytest.mark.parametrize("n", [1, 4, 100, 32768, 1000003, 2**31 - 1, 2**31])
def test_md5_mod(spark, n):
    texts = ["", "a", "mouse0", "žluťoučký kůň", "日本語12", "x" * 5000] + [f"v{i}" for i in range(200)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", md5_mod(F.col("t"), n).alias("b"))
    for row in rows.collect():
        assert row["b"] == int(hashlib.md5(row["t"].encode()).hexdigest(), 16) % n


def test_md5_mod_refuses_inexact_sizes():
    with pytest.raises(ValueError):
        md5_mod(F.lit("a"), 2**31 + 1)


@pytest.mark.parametrize(
    "feats, n, expected",
    [
        (["mouse", "black"], 4, {2: 1.0, 3: 1.0}),
        (["bear", "black", "salmon"], 100, {72: 1.0, 5: 1.0, 14: 1.0}),
        (["cat", "tabby", "mouse"], 4, {0: 2.0, 2: 1.0}),
    ],
)
def test_hashed_features(spark, feats, n, expected):
    lines = spark.createDataFrame([(1, ",".join(["0", *feats]))], "obs_id bigint, line string")
    row = encode_hashed(parse_observations(lines), n).first()
    assert dict(zip(row["indices"], row["values"])) == expected
    assert row["indices"] == sorted(row["indices"])


def test_equal_feature_strings_count_once(spark):
    # position 1 holds "11" and position 11 holds "1": both spell "111"
    feats = [""] * 12
    feats[1], feats[11] = "11", "1"
    lines = spark.createDataFrame([(1, ",".join(["0", *feats]))], "obs_id bigint, line string")
    row = encode_hashed(parse_observations(lines), 100).first()
    names = {value + str(i) for i, value in enumerate(feats)}
    assert sum(row["values"]) == len(names) == 11
    assert dict(zip(row["indices"], row["values"]))[88] >= 1.0


@pytest.mark.parametrize("x", [0.0, 0.5358441, 1.6717677e-4, 1.1805561e-3, -12345.678, 1e-300, 3.0, 18135.4834348])
def test_number_formats(spark, x):
    row = spark.createDataFrame([(x,)], "x double").select(
        fixed_text(F.col("x")), scientific_text(F.col("x")), fixed_text(F.col("x"), 0), scientific_text(F.col("x"), 1)
    ).first()
    assert tuple(row) == (f"{x:.3f}", f"{x:.7e}", f"{x:.0f}", f"{x:.1e}")


def test_number_formats_of_nothing(spark):
    rows = spark.createDataFrame([(None,)], "x double").select(fixed_text(F.col("x")), scientific_text(F.col("x")))
    assert tuple(rows.first()) == (None, None)
