"""Embedding whitening: principal components by contour integration, rows scaled to unit variance."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.feast import largest_eigenpairs
from clickweave.plans.scratch import discard, scratch_path

COMPONENTS = 4
# entries become whole multiples of 1 / SCALE
SCALE = 256
# |SCALE * entry| from here on is no long any more; such entries count as not finite
_LARGEST = float(1 << 61)
# entries of a block of rows that is worked on at once
_BLOCK = 1 << 20


class Whitening(NamedTuple):
    """What the distinct vectors say: their number, sums per dimension, and the components found."""

    n: int
    sums: list[int]
    # one column per component, by falling eigenvalue
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    # largest deviation of the whitened covariance from the identity
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean per dimension as whole part and remainder times n."""
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64)


def _grid(vector: str) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))


def _usable(vector: str) -> Column:
    held = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < F.lit(_LARGEST)))
    return F.col(vector).isNotNull() & held


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """Rows of ``x`` as matrices of bounded size."""
    step = max(1, _BLOCK // max(size, 1))
    for batch in batches:
        column = batch.column("x")
        for at in range(0, len(column), step):
            yield column.slice(at, step).flatten().to_numpy().reshape(-1, size)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, [0] * size, [0] * size
        for x in _blocks(batches, size):
            n += len(x)
            # halves cannot overflow; their sums are of any size
            high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0))]
            low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0))]
        totals = [Decimal((a << 32) + b) for a, b in zip(high, low)]
        columns = [
            pa.array(range(size), pa.int32()),
            pa.array(totals, pa.decimal128(38, 0)),
            pa.array([n] * size, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["i", "s", "n"])

    parts = fit.mapInArrow(run, "i int, s decimal(38,0), n bigint")
    rows = parts.groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    by = {r["i"]: r for r in rows}
    return int(by[0]["n"]), [int(by[i]["s"]) for i in range(size)]


def _covariance(fit: DataFrame, model: Whitening) -> np.ndarray:
    """Centred products of the distinct vectors, summed per task and then by Spark, over their number."""
    size = len(model.sums)
    whole, rest = model.centre()
    mean = rest / model.n
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for x in _blocks(batches, size):
            centred = (x - whole) - mean
            total += centred.T @ centred
        found = [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])]
        yield pa.RecordBatch.from_arrays(found, ["i", "j", "v"])

    parts = fit.mapInArrow(run, "i int, j int, v double")
    rows = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((size, size))
    i, j = rows["i"].to_numpy(), rows["j"].to_numpy()
    out[i, j] = rows["v"].to_numpy() / model.n
    out[j, i] = out[i, j]
    return out


def _project(model: Whitening, x: np.ndarray) -> np.ndarray:
    whole, rest = model.centre()
    return ((x - whole) - rest / model.n) @ (model.components / np.sqrt(model.eigenvalues))


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    size, count = len(model.sums), len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _blocks(batches, size):
            whitened = _project(model, x)
            yield pa.RecordBatch.from_arrays([pa.array(whitened[:, k]) for k in range(count)], names)

    names = [f"w{k}" for k in range(count)]
    whitened = fit.mapInArrow(run, ", ".join(f"{w} double" for w in names))
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    # covar_pop centres before it multiplies
    row = whitened.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max((abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs), default=0.0)


def fit_whitening(
    vectors: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS
) -> Whitening | None:
    """Components of the distinct vectors, each counted once however often it comes.

    Entries become floor(256 * entry).  Null vectors, those with null or not
    finite entries, and those of another length than most distinct ones have
    (ties: the longer) are left out.  None if nothing is left.  Components
    without variance are not returned, so there may be fewer than asked for.
    The driver holds sums and products per dimension, never rows.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "whitening-fit")
    # equal vectors are combined in the map task, so a frequent one is no task's own work
    vectors.where(_usable(vector)).select(_grid(vector).alias("x")).distinct().write.parquet(path)
    distinct = spark.read.parquet(path)
    lengths = distinct.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None or most["size"] == 0:
        discard(spark, path)
        return None
    size = most["size"]
    fit = distinct.where(F.size("x") == size)
    n, sums = _sums(fit, size)
    model = Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0, 0.0)
    covariance = _covariance(fit, model)
    values, found = largest_eigenpairs(covariance, components)
    model = model._replace(components=found, eigenvalues=values, trace=float(np.trace(covariance)))
    model = model._replace(identity_error=_identity_error(fit, model) if len(values) else 0.0)
    discard(spark, path)
    return model


def _deviation(model: Whitening, x: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n * x - S)**2, exact."""
    whole, rest = model.centre()
    kind = pa.decimal128(38, 0)
    y = x - whole
    reach = int(np.abs(y).max(initial=0)) + 1
    if len(whole) * (model.n * reach) ** 2 < 1 << 63:
        terms = model.n * y - rest
        return pa.array((terms * terms).sum(axis=1)).cast(kind)
    sums = [sum((model.n * int(a) - int(r)) ** 2 for a, r in zip(row, rest)) for row in y]
    return pa.array([Decimal(s) if s < 10**38 else None for s in sums], kind)


def whiten(
    vectors: DataFrame, model: Whitening | None, *, vector: str = "embedding", carry: Sequence[str] = ("vec_id",)
) -> DataFrame:
    """Whitened coordinates of every usable row of ``vectors``.

    Returns doc (a struct of the columns named in ``carry``), deviation (the sum
    of (n * x - S)**2 over the dimensions, exact; null from 10**38 on) and
    whitened, one coordinate per component of the model.  Rows that
    :func:`fit_whitening` leaves out have no row here; rows that repeat, with or
    without an id, each have their own; columns not carried are ignored; an
    empty table or no model gives no rows.
    """
    doc = F.struct(*carry) if carry else F.struct(F.lit(0).alias("_"))
    usable = vectors.where(_usable(vector)).select(doc.alias("doc"), _grid(vector).alias("x"))
    size = len(model.sums) if model else 0
    usable = usable.where(F.size("x") == size) if model else usable.where(F.lit(False))
    schema = usable.select("doc").schema
    schema = schema.add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType()))
    step = max(1, _BLOCK // max(size, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = part.column("x").flatten().to_numpy().reshape(-1, size)
                whitened = _project(model, x)
                bounds = pa.array(np.arange(len(x) + 1, dtype=np.int32) * whitened.shape[1])
                lists = pa.ListArray.from_arrays(bounds, pa.array(whitened.ravel(), pa.float64()))
                columns = [part.column("doc"), _deviation(model, x), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "deviation", "whitened"])

    return usable.mapInArrow(run, schema)
