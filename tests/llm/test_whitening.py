"""Whitening: the eigen solver against a dense one, the query against a plain version."""

import random

import numpy as np
import pytest

from clickweave.llm.feast import count_above, eigenpairs, largest_eigenpairs, top_intervals, tridiagonal
from clickweave.llm.queries import op11_embedding_whitening
from clickweave.llm.whitening import fit_whitening, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def matrices(kind, size):
    x = np.random.default_rng(size).standard_normal((400, size))
    if kind == "steep":
        x = x / np.arange(1, size + 1) ** 3
    if kind == "one large":
        x[:, 0] *= 1e4
    if kind == "rank 1":
        x = np.round(x[:, :1] * 9).repeat(size, 1)
    return np.cov(x.T, bias=True).reshape(size, size)


@pytest.mark.parametrize("size", [1, 2, 5, 64])
@pytest.mark.parametrize("kind", ["flat", "steep", "one large", "rank 1"])
def test_eigenpairs(kind, size):
    a = matrices(kind, size)
    values, vectors = largest_eigenpairs(a, 4)
    expected, others = np.linalg.eigh(a)
    assert len(values) == (1 if kind == "rank 1" else min(4, size))
    assert np.allclose(values, expected[::-1][: len(values)], rtol=1e-12)
    assert np.allclose(np.abs((vectors * others[:, ::-1][:, : len(values)]).sum(axis=0)), 1, atol=1e-11)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)


def test_inertia_counts():
    a = matrices("flat", 30)
    shifts = np.linspace(-1, 3, 200)
    expected = [(np.linalg.eigvalsh(a) > s).sum() for s in shifts]
    assert count_above(*tridiagonal(a), shifts).tolist() == expected


def test_intervals_hold_every_large_eigenvalue_and_repeats():
    a = np.diag([5.0, 5.0, 5.0, 3.0, 3.0, 1.0, 0.0])
    intervals = top_intervals(a, 4, 5.0)
    assert sum(i.count for i in intervals) >= 4
    assert sorted(np.concatenate([eigenpairs(a, i, 5.0)[0] for i in intervals]))[::-1][:4] == pytest.approx([5, 5, 5, 3])
    values, vectors = largest_eigenpairs(a, 5)
    assert values == pytest.approx([5, 5, 5, 3, 3])
    assert np.allclose(a @ vectors, vectors * values)
    assert len(largest_eigenpairs(np.zeros((3, 3)), 4)[0]) == 0


def rows(size=6, n=120):
    rng = random.Random(3)
    # a large common part, so that sums of plain products would lose the rest
    vectors = [[3000.0 + rng.gauss(0, k + 1) for k in range(size)] for _ in range(n)]
    out = [(i, v, 0) for i, v in enumerate(vectors)]
    out += [(1000 + i, vectors[0], 0) for i in range(60)]
    odd = [None, [], [1.0], [None] * size, [float("nan")] * size, [float("inf")] * size, [1e30] * size]
    out += [(2000 + i, v, 0) for i, v in enumerate(odd)]
    return [*out, out[5], (None, vectors[7], None), (None, None, None)]


def plain(data, size, k):
    usable = []
    for vec_id, v, _ in data:
        v = np.array([np.nan if c is None else c for c in v or []], np.float32).astype(float)
        if len(v) == size and np.all(np.abs(v) < 1e17):
            usable.append((vec_id, [int(c) for c in np.floor(256 * v)]))
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], dtype=float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for vec_id, x in usable:
        y = [n * c - s for c, s in zip(x, sums)]
        w = (np.array(y, float) / n) @ vectors[:, ::-1][:, :k] / np.sqrt(values[::-1][:k])
        out.setdefault(vec_id, []).append((n, sum(c * c for c in y), np.abs(w)))
    return out, values[::-1][:k] / values.sum()


def test_query(spark, tmp_path):
    data = rows()
    spark.createDataFrame(data, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op11_embedding_whitening(spark, str(tmp_path))
    kinds = dict(found.dtypes)
    assert [kinds[c] for c in ("component", "n", "deviation", "whitened", "explained", "identity_error")] == [
        "int", "bigint", "bigint", "double", "double", "double",
    ]
    got = found.collect()
    expected, shares = plain(data, 6, 4)
    assert len(got) == 4 * sum(len(v) for v in expected.values())
    for r in got:
        n, deviation, w = expected[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation) or r.vec_id in (None, 5)
        assert abs(r.whitened) == pytest.approx(w[r.component - 1], abs=1e-8)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-10)
        assert r.identity_error < 1e-8
    assert sum(r.vec_id == 5 for r in got) == 8 and sum(r.vec_id is None for r in got) == 4
    # one sign for all rows
    first = {r.vec_id: r.whitened for r in got if r.component == 1}
    assert abs(np.mean([first[i] for i in range(120)])) < 0.1


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected, shares = plain(data, 64, 4)
    for r in op11_embedding_whitening(spark, folder).collect():
        n, deviation, w = expected[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(w[r.component - 1], abs=1e-8)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-10)


@pytest.mark.parametrize("data", [[], [(1, None, 0)], [(1, [], 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)]])
def test_nothing_to_whiten(spark, tmp_path, data):
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op11_embedding_whitening(spark, str(tmp_path))
    assert "whitened" in found.columns and found.count() == 0


def test_columns_and_large_numbers(spark):
    data = [(i, [float(i % 7) * 2.0**40, float(i)], "d") for i in range(50)]
    vectors = spark.createDataFrame(data, "x long, embedding array<double>, doc string")
    model = fit_whitening(vectors, components=9)
    found = whiten(vectors, model, carry=["doc", "x"]).orderBy("doc.x").collect()
    points = [[int(256 * c) for c in v] for _, v, _ in data]
    sums = [sum(c) for c in zip(*points)]
    assert model.n == 50 and model.sums == sums
    for r, x in zip(found, points):
        assert int(r.deviation) == sum((50 * c - s) ** 2 for c, s in zip(x, sums))
        assert r.doc.doc == "d"
