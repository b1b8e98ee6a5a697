"""Logistic regression by gradient descent, whole or in mini-batches.

The update rule, for the n rows of the batch, weights w (zeros) and intercept b
(starting at 1)::

    p      = 1 / (1 + exp(-(w.x + b)))
    g_j    = mean((p - y) x_j),  g_b = mean(p - y)
    eta_i  = step / sqrt(i)
    w, b   = shrink((w, b) - eta_i (g, g_b))
    stop at i > 1 when |new - old| < tol max(|new|, 1), both over (w, b)

``shrink`` depends on the kind of regularisation: ``l2`` takes eta_i reg (w, b)
of the old values off, ``l1`` moves every new value towards zero by eta_i reg
and no further than zero (the proximal step), ``None`` does nothing.

The intercept is the weight of a bias entry that every row carries, so rows
without any non-zero count too; without an intercept there is no such entry,
and it is part neither of the stop rule nor of the model.  Any number of models
(step, reg, kind) is fitted together: each iteration is one pass over the data
for all of them.

With a batch fraction below 1, step i uses the rows whose draw, a function of
seed, step and row key alone, falls below the fraction: the same rows on every
retry and on every path.  A step whose batch is empty changes nothing.

* :func:`gd_step` is one iteration as a lazy plan over DataFrames only.
* :func:`fit_sgd` iterates.  While all weights together stay below a checked
  bound they are sent out as one broadcast and every task returns its share of
  the gradient, from rows packed once into blocks of arrays; beyond it they stay
  a distributed table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.functions.hashing import MIX_FACTOR, md5_u32, mixed_u32
from clickweave.functions.scalar import sigmoid
from clickweave.plans.lookup import (
    BROADCAST_BYTES,
    fits,
    hot_keys,
    left_lookup,
    reduce_tasks,
    salted_rows,
    salted_table,
)
from clickweave.plans.scratch import discard, materialize, scratch_path

BIAS_INDEX = -1
INITIAL_INTERCEPT = 1.0
TOLERANCE = 1e-3
# weights of all models together that may be held by the driver and each worker
BROADCAST_PARAMETERS = 1 << 22
# gradient numbers one reduce task adds up
SHARES_PER_REDUCER = 4_000_000
# fewer rows than this are not worth a task of their own
ROWS_PER_TASK = 10_000
# gradient shares per core
TASKS_PER_CORE = 2
# rows and entries of a block of packed rows, and entries that a task works on at once
ROWS_PER_BLOCK, ENTRIES_PER_BLOCK = 2_048, 1 << 17
ENTRIES_AT_ONCE = 1 << 17
# numbers of a gradient that travel together; places among them take 16 bits
PIECE = 1 << 15
# more numbers than this are not sent to the driver twice
NUMBERS_ADDED_HERE = 1 << 16
REG_TYPES = ("l2", "l1", None)
SEED = 42


@dataclass(frozen=True)
class Setting:
    """Hyper-parameters of one model."""

    step_size: float
    reg_param: float
    reg_type: str | None = "l2"

    def __post_init__(self):
        if self.reg_type not in REG_TYPES:
            raise ValueError(f"regularisation must be one of {REG_TYPES}, got {self.reg_type!r}")


@dataclass(frozen=True)
class Batches:
    """Which rows a step uses: a share of them, drawn by the hash of ``key``."""

    fraction: float = 1.0
    seed: int = SEED
    key: str = "obs_id"

    def __post_init__(self):
        if not 0.0 < self.fraction <= 1.0:
            raise ValueError(f"a batch is a share in (0, 1], got {self.fraction}")

    @property
    def whole(self) -> bool:
        return self.fraction >= 1.0

    @property
    def cut(self) -> int:
        return round(self.fraction * (1 << 32))

    def base(self) -> Column:
        """32 bits per row; rows with one key are drawn together, and so are rows without a key."""
        text = F.concat(F.lit(f"batch:{self.seed}:"), F.coalesce(F.col(self.key).cast("string"), F.lit("")))
        return md5_u32(text)

    def drawn(self, base: Column, step: int) -> Column:
        """Whether step ``step`` uses a row."""
        return mixed_u32(base.bitwiseXOR(F.lit(mixed(step)).cast("bigint"))) < F.lit(self.cut)

    def drawn_array(self, base: np.ndarray, step: int) -> np.ndarray:
        """The same for an array."""
        return mixed(base ^ np.uint64(mixed(step))) < np.uint64(self.cut)


WHOLE = Batches()


def mixed(x):
    """:func:`mixed_u32` for a number or an array of unsigned 64-bit numbers."""
    low = (1 << 32) - 1
    for _ in range(2):
        x = ((x ^ (x >> 16)) * MIX_FACTOR) & low
    return x ^ (x >> 16)


@dataclass(frozen=True)
class Fitted:
    """Models fitted together: ``weights`` is ``(idx, weights ARRAY<DOUBLE>)``, one entry per model."""

    settings: list[Setting]
    weights: DataFrame
    intercepts: list[float]
    iterations: list[int]

    def model(self, k: int = 0) -> DataFrame:
        """Weights of one model as ``(idx, weight)``."""
        return self.weights.select("idx", F.col("weights")[k].alias("weight"))


def _eta(setting: Setting, iteration: int) -> float:
    return setting.step_size / math.sqrt(iteration)


# ---------------------------------------------------------------- DataFrame step


def training_rows(encoded: DataFrame, batches: Batches = WHOLE) -> DataFrame:
    """The rows with an id of their own (``_row``), fixed by writing them once, so equal rows stay apart.

    With mini-batches they also carry ``_base``, what their draws depend on.
    """
    base = [] if batches.whole else [batches.base().alias("_base")]
    rows = encoded.select("label", "indices", "values", *base)
    return materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "training-rows")


def bias_entries(rows: DataFrame, intercept: bool = True) -> DataFrame:
    """Non-zeros of :func:`training_rows`, laid out so that a row's entries sit together.

    With an intercept every row has one bias entry more.
    """
    idx, val = F.col("indices"), F.col("values")
    if intercept:
        idx = F.concat(F.array(F.lit(BIAS_INDEX).cast("bigint")), idx)
        val = F.concat(F.array(F.lit(1.0)), val)
    carried = [c for c in rows.columns if c not in ("indices", "values")]
    pairs = F.arrays_zip(idx.alias("idx"), val.alias("val"))
    return (
        rows.repartition(reduce_tasks(rows.sparkSession), "_row")
        .select(*carried, F.inline_outer(pairs).alias("idx", "val"))
        .where(F.col("idx").isNotNull())
        .sortWithinPartitions("_row")
    )


def entries_by_index(entries: DataFrame, hot: DataFrame) -> DataFrame:
    """The same entries where the weights of their index will be; frequent indices are spread."""
    n = reduce_tasks(entries.sparkSession)
    salted = salted_rows(entries.drop("label"), ["idx"], hot, "_row")
    # in the order of the join with the weights, which then sorts nothing at any iteration
    return salted.repartition(n, "idx", "_salt").sortWithinPartitions("idx", "_salt")


def initial_weights(spark: SparkSession, dimension: int, n_models: int = 1, intercept: bool = True) -> DataFrame:
    """Zero weights, bias (if there is one) at its start value."""
    start = F.when(F.col("id") == BIAS_INDEX, F.lit(INITIAL_INTERCEPT)).otherwise(F.lit(0.0))
    return spark.range(BIAS_INDEX if intercept else 0, dimension).select(
        F.col("id").alias("idx"), F.array_repeat(start, n_models).alias("weights")
    )


def _margins_in_place(entries: DataFrame, weights: DataFrame, n_models: int) -> DataFrame:
    """Entries with the margins of their row: broadcast weights, and a window over adjacent rows."""
    found = left_lookup(entries, weights, ["idx"], ["weights"], small=True)
    of_row = Window.partitionBy("_row")
    margin = [
        F.sum(F.col("val") * F.coalesce(F.col("weights")[k], F.lit(0.0))).over(of_row).alias(f"_m{k}")
        for k in range(n_models)
    ]
    return found.select("label", "idx", "val", *margin)


def _margins_by_index(
    entries: DataFrame, by_index: DataFrame, weights: DataFrame, hot: DataFrame, n_models: int
) -> DataFrame:
    """The same for weights too large to broadcast.

    Both layouts of the entries stay where they are.  The weights come to the
    entries of their index, partial margins, added per row and task, go to the
    entries of their row.
    """
    found = by_index.join(salted_table(weights, ["idx"], hot), ["idx", "_salt"], "left")
    margin = [
        F.sum(F.col("val") * F.coalesce(F.col("weights")[k], F.lit(0.0))).alias(f"_m{k}") for k in range(n_models)
    ]
    of_row = found.groupBy("_row").agg(*margin)
    return entries.join(of_row, "_row").select("label", "idx", "val", *[f"_m{k}" for k in range(n_models)])


def gd_step(
    entries: DataFrame,
    weights: DataFrame,
    n_rows: int,
    iteration: int,
    settings: Sequence[Setting],
    *,
    active: Sequence[bool] | None = None,
    by_index: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Weights after one more iteration, ``(idx, weights, previous)``.

    ``entries`` comes from :func:`bias_entries`; for a mini-batch it, ``by_index``
    and ``n_rows`` are those of the batch.  Weights that may be broadcast
    need no more; for larger ones ``by_index`` is the second layout of the
    entries and ``hot`` their frequent indices.  Either way the entries do not
    move: only margins added per row and gradients added per index do.
    """
    active = active or [True] * len(settings)
    n_models = len(settings)
    if by_index is None:
        scored = _margins_in_place(entries, weights.select("idx", "weights"), n_models)
    else:
        scored = _margins_by_index(entries, by_index, weights.select("idx", "weights"), hot, n_models)
    gradient = scored.groupBy("idx").agg(
        *[
            (F.sum(F.col("val") * (sigmoid(F.col(f"_m{k}")) - F.col("label"))) / F.lit(n_rows)).alias(f"_g{k}")
            for k in range(n_models)
        ]
    )
    updated = []
    for k, setting in enumerate(settings):
        old, eta = F.col("weights")[k], _eta(setting, iteration)
        shrinkage = eta * setting.reg_param
        kept = 1.0 - shrinkage if setting.reg_type == "l2" else 1.0
        new = old * F.lit(kept) - F.lit(eta) * F.coalesce(f"_g{k}", F.lit(0.0))
        if setting.reg_type == "l1":
            new = F.signum(new) * F.greatest(F.abs(new) - F.lit(shrinkage), F.lit(0.0))
        updated.append(new if active[k] else old)
    return weights.join(gradient, "idx", "left").select(
        "idx", F.array(*updated).alias("weights"), F.col("weights").alias("previous")
    )


def _moved(table: DataFrame, n_models: int) -> list[tuple[float, float]]:
    """Squared length of the change and of the new weights, per model."""
    sums = []
    for k in range(n_models):
        new, old = F.col("weights")[k], F.col("previous")[k]
        sums += [F.sum((new - old) * (new - old)), F.sum(new * new)]
    row = table.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    return [(row[2 * k], row[2 * k + 1]) for k in range(n_models)]


def _converged(change2: float, size2: float, tol: float) -> bool:
    return math.sqrt(change2) < tol * max(math.sqrt(size2), 1.0)


def _check_top(top: int | None, dimension: int) -> None:
    if top is not None and top >= dimension:
        raise ValueError(f"index {top} does not fit the dimension {dimension}")


def _checked_rows(encoded: DataFrame, dimension: int) -> int:
    """Number of rows, after a check that no index lies outside of the dimension."""
    counted = encoded.agg(F.count("*").alias("n"), F.max(F.array_max("indices")).alias("top")).first()
    _check_top(counted["top"], dimension)
    return counted["n"]


def _fit_distributed(
    encoded: DataFrame,
    dimension: int,
    settings: Sequence[Setting],
    iterations: int,
    tol: float,
    broadcast_bytes: int,
    intercept: bool,
    batches: Batches,
) -> Fitted:
    """Weights stay a table; every iteration writes the next one, so plans do not grow.

    Of those tables the last two exist at any time.
    """
    spark = encoded.sparkSession
    n_models = len(settings)
    rows = training_rows(encoded, batches)
    # counted on what was written: the encoding is not worked out twice
    n_rows = _checked_rows(rows, dimension)
    entries = bias_entries(rows, intercept).persist(StorageLevel.MEMORY_AND_DISK)
    by_index = hot = None
    try:
        weights = initial_weights(spark, dimension, n_models, intercept)
        if not fits(weights, broadcast_bytes, row_bytes=64 + 8 * n_models):
            hot = hot_keys(entries, ["idx"])
            by_index = entries_by_index(entries, hot).persist(StorageLevel.MEMORY_AND_DISK)
        active, used = [True] * n_models, [0] * n_models
        written: list[str] = []
        for i in range(1, iterations + 1):
            size, batch, batch_by_index = n_rows, entries, by_index
            if not batches.whole:
                drawn = batches.drawn(F.col("_base"), i)
                size = rows.where(drawn).count()
                batch, batch_by_index = entries.where(drawn), by_index.where(drawn) if by_index is not None else None
            if not size:
                continue
            step = gd_step(batch, weights, size, i, settings, active=active, by_index=batch_by_index, hot=hot)
            written.append(scratch_path(spark, "weights"))
            table = materialize(step, "weights", written[-1])
            if len(written) > 2:
                discard(spark, written.pop(0))
            used = [i if on else u for on, u in zip(active, used)]
            if tol > 0 and i > 1:
                moved = _moved(table, n_models)
                active = [on and not _converged(*m, tol) for on, m in zip(active, moved)]
            weights = table.select("idx", "weights")
            if not any(active):
                break
    finally:
        entries.unpersist()
        if by_index is not None:
            by_index.unpersist()
    bias = weights.where(F.col("idx") == BIAS_INDEX).first()["weights"] if intercept else [0.0] * n_models
    return Fitted(list(settings), weights.where(F.col("idx") != BIAS_INDEX), list(bias), used)


# ---------------------------------------------------------------- bounded model


_BLOCKS = "n int, top bigint, labels binary, sizes binary, idx binary, val binary, base binary"
_PIECES = "place bigint, used bigint, at binary, g binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as blocks of arrays: every later pass reads a few blobs in place of many lists.

    Values that are all 1 are left out, and so are draws where there are none.  An index
    too large for its 32 bits is told by ``top``, which is checked before any block is used.
    """
    for batch in batches:
        lists = batch.column("indices")
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int32)
        idx, val = lists.flatten().to_numpy(), batch.column("values").flatten().to_numpy()
        label = batch.column("label").to_numpy()
        drawn = "_base" in batch.schema.names
        base = batch.column("_base").to_numpy(zero_copy_only=False) if drawn else np.empty(0, np.int64)
        before = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        low, blocks = 0, []
        while low < batch.num_rows:
            high = int(np.searchsorted(before, before[low] + ENTRIES_PER_BLOCK, "right")) - 1
            high = min(max(high, low + 1), low + ROWS_PER_BLOCK, batch.num_rows)
            own = slice(before[low], before[high])
            top = int(idx[own].max()) if before[high] > before[low] else None
            values = val[own] if (val[own] != 1.0).any() else val[:0]
            parts = label[low:high], sizes[low:high], idx[own].astype(np.int32), values, base[low:high]
            blocks.append((high - low, top, *[np.ascontiguousarray(p).tobytes() for p in parts]))
            low = high
        columns = list(zip(*blocks)) if blocks else [()] * 7
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
        names = ["n", "top", "labels", "sizes", "idx", "val", "base"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def _unpacked(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Labels, sizes, indices, values and bases of as many blocks as are worked on at once."""
    kinds = np.float64, np.int32, np.int32, np.float64, np.int64
    for batch in batches:
        columns = [batch.column(c) for c in ("labels", "sizes", "idx", "val", "base")]
        held: list[list[np.ndarray]] = []
        entries = 0
        for row in zip(*columns):
            parts = [np.frombuffer(blob.as_buffer(), kind) for blob, kind in zip(row, kinds)]
            if len(parts[3]) < len(parts[2]):
                parts[3] = np.ones(len(parts[2]))
            held.append(parts)
            entries += len(parts[2])
            if entries >= at_once:
                yield tuple(np.concatenate(p) for p in zip(*held))
                held, entries = [], 0
        if held:
            yield tuple(np.concatenate(p) for p in zip(*held))


def _pieces(numbers: Iterable[tuple[int, np.ndarray]], used: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a gradient by their place in it, as all numbers or as the places and numbers that are not 0.

    Pieces of zeros only are left out.  The number of rows used goes with the first piece of all.
    """
    for place, piece in numbers:
        at = np.flatnonzero(piece)
        if not at.size and not used:
            continue
        dense = 5 * at.size >= 4 * piece.size
        blobs = [b"" if dense else at.astype(np.uint16).tobytes(), (piece if dense else piece[at]).tobytes()]
        columns = [pa.array([place]), pa.array([used]), *[pa.array([b], pa.binary()) for b in blobs]]
        yield pa.RecordBatch.from_arrays(columns, ["place", "used", "at", "g"])
        used = 0


def _add_piece(total: np.ndarray, at: pa.Scalar, g: pa.Scalar) -> None:
    """Add a piece to ``total``, which begins where the piece does."""
    numbers, places = np.frombuffer(g.as_buffer()), np.frombuffer(at.as_buffer(), np.uint16)
    if places.size:
        total[places] += numbers
    else:
        total[: numbers.size] += numbers


def _gradient_shares(
    sent: Broadcast, models: Sequence[int], intercept: bool, drawn: tuple[Batches, int] | None, at_once: int
):
    """Task function: what the rows of one task add to the gradient of each given model, in pieces.

    The bias has the index behind all others.
    """

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        bias = weights.shape[1] - 1
        gradient = np.zeros((len(models), bias + 1))
        used = 0
        # so few entries that they take little room, but not so few that adding them up is most of the work
        for label, sizes, idx, val, base in _unpacked(batches, max(at_once, bias)):
            row = np.repeat(np.arange(len(label), dtype=np.int32), sizes)
            inside = np.ones(len(label), dtype=bool)
            if drawn:
                inside = drawn[0].drawn_array(base.astype(np.uint64), drawn[1])
                chosen = inside[row]
                row, idx, val = row[chosen], idx[chosen], val[chosen]
            used += int(inside.sum())
            for g, k in zip(gradient, models):
                dot = np.bincount(row, weights=val * weights[k, idx], minlength=len(label))
                with np.errstate(over="ignore"):
                    residual = (1.0 / (1.0 + np.exp(-(dot + weights[k, bias]))) - label) * inside
                g[:bias] += np.bincount(idx, weights=val * residual[row], minlength=bias)
                if intercept:
                    g[bias] += residual.sum()
        flat = gradient.ravel()
        yield from _pieces(((p, flat[p : p + PIECE]) for p in range(0, flat.size, PIECE)), used)

    return shares


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the pieces of each place added up."""
    totals: dict[int, np.ndarray] = {}
    used = 0
    for batch in batches:
        for place, rows, at, g in zip(*batch.columns):
            _add_piece(totals.setdefault(place.as_py(), np.zeros(PIECE)), at, g)
            used += rows.as_py()
    yield from _pieces(totals.items(), used)


def _gradient(
    blocks: DataFrame,
    weights: np.ndarray,
    models: Sequence[int],
    reducers: int,
    intercept: bool,
    drawn: tuple[Batches, int] | None,
) -> tuple[np.ndarray, int, bool]:
    """Summed gradient of every given model, of the size of the weights, and the number of rows used.

    ``reducers`` is 0 where all shares together are few enough to be added here.  The last
    value says whether much less would have come here if they had been added before.
    """
    sent = blocks.sparkSession.sparkContext.broadcast(weights)
    try:
        task = _gradient_shares(sent, models, intercept, drawn, ENTRIES_AT_ONCE)
        shares = blocks.mapInArrow(task, _PIECES)
        if reducers:
            shares = shares.repartition(reducers, "place").mapInArrow(_added, _PIECES)
        total = shares.toArrow()
    finally:
        sent.destroy()
    # room behind the last piece, which may come at full length
    summed = np.zeros(-(-len(models) * weights.shape[1] // PIECE) * PIECE)
    for place, at, g in zip(total["place"].to_pylist(), total["at"], total["g"]):
        _add_piece(summed[place:], at, g)
    come = sum(len(g.as_buffer()) for g in total["g"]) // 8
    much = come > NUMBERS_ADDED_HERE and come > 1.2 * np.count_nonzero(summed)
    gradient = np.zeros_like(weights)
    gradient[list(models)] = summed[: len(models) * weights.shape[1]].reshape(len(models), -1)
    return gradient, sum(total["used"].to_pylist()), much


def _reducers(tasks: int, parameters: int, limit: int) -> int:
    """Reduce tasks for ``tasks`` gradient shares of up to ``parameters`` numbers each."""
    shares = tasks * parameters
    return 0 if shares <= SHARES_PER_REDUCER else min(limit, -(-shares // SHARES_PER_REDUCER))


def _spread(blocks: DataFrame, n_rows: int) -> DataFrame:
    """The cached blocks in a sensible number of tasks, as every iteration reads them.

    Every task returns a share of the gradient, so their number follows the
    cores, not the partitions of the input: more partitions than a few per core
    are merged in place.  Blocks in fewer partitions than there are cores are
    spread once.
    """
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-n_rows // ROWS_PER_TASK), TASKS_PER_CORE * cores))
    present = blocks.rdd.getNumPartitions()
    enough = min(tasks, cores)
    if present > tasks:
        return blocks.coalesce(tasks)
    if present < enough:
        spread = blocks.repartition(enough).persist(StorageLevel.MEMORY_AND_DISK)
        spread.count()
        return spread
    return blocks


def _updated(old: np.ndarray, gradient: np.ndarray, setting: Setting, iteration: int) -> np.ndarray:
    eta = _eta(setting, iteration)
    shrinkage = eta * setting.reg_param
    if setting.reg_type == "l2":
        return old * (1.0 - shrinkage) - eta * gradient
    new = old - eta * gradient
    if setting.reg_type == "l1":
        new = np.sign(new) * np.maximum(np.abs(new) - shrinkage, 0.0)
    return new


def _fit_broadcast(
    encoded: DataFrame,
    dimension: int,
    settings: Sequence[Setting],
    iterations: int,
    tol: float,
    intercept: bool,
    batches: Batches,
) -> Fitted:
    """Weights of all models fit a broadcast: one narrow pass and one small aggregate per iteration."""
    spark = encoded.sparkSession
    n_models = len(settings)
    base = [] if batches.whole else [batches.base().alias("_base")]
    # packed where they are: no shuffle just to fit
    rows = encoded.select("label", "indices", "values", *base)
    packed = rows.mapInArrow(_pack, _BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
    weights = np.zeros((n_models, dimension + 1))
    weights[:, dimension] = INITIAL_INTERCEPT if intercept else 0.0
    active, used = list(range(n_models)), [0] * n_models
    blocks = packed
    try:
        counted = packed.agg(F.sum("n").alias("n"), F.max("top").alias("top")).first()
        _check_top(counted["top"], dimension)
        blocks = _spread(packed, counted["n"] or 0)
        limit = int(spark.conf.get("spark.sql.shuffle.partitions"))
        reducers = _reducers(blocks.rdd.getNumPartitions(), weights.size, limit)
        for i in range(1, iterations + 1):
            drawn = None if batches.whole else (batches, i)
            gradient, size, much = _gradient(blocks, weights, active, reducers, intercept, drawn)
            if much and not reducers:
                reducers = min(limit, -(-weights.size // PIECE))
            if not size:
                continue
            moved = weights.copy()
            for k in active:
                moved[k] = _updated(weights[k], gradient[k] / size, settings[k], i)
                used[k] = i
            if tol > 0 and i > 1:
                change, length = ((moved - weights) ** 2).sum(axis=1), (moved**2).sum(axis=1)
                active = [k for k in active if not _converged(change[k], length[k], tol)]
            weights = moved
            if not active:
                break
    finally:
        packed.unpersist()
        blocks.unpersist()
    columns = weights[:, :dimension]
    flat = pa.array(np.ascontiguousarray(columns.T).ravel())
    offsets = pa.array(np.arange(dimension + 1, dtype=np.int32) * n_models)
    table = pa.table(
        {"idx": pa.array(np.arange(dimension)), "weights": pa.ListArray.from_arrays(offsets, flat)}
    )
    return Fitted(list(settings), spark.createDataFrame(table), weights[:, dimension].tolist(), used)


def fit_sgd(
    encoded: DataFrame,
    dimension: int,
    settings: Sequence[Setting],
    iterations: int,
    tol: float = TOLERANCE,
    broadcast_parameters: int = BROADCAST_PARAMETERS,
    broadcast_bytes: int = BROADCAST_BYTES,
    *,
    intercept: bool = True,
    batches: Batches = WHOLE,
) -> Fitted:
    """Fit one model per setting, at most ``iterations`` steps each, all in the same passes.

    Without ``intercept`` the models have none (0.0 is returned for it).
    ``batches`` says which rows each step uses; only fractions below 1 need
    their key column in ``encoded``.
    """
    if len(settings) * (dimension + 1) <= broadcast_parameters:
        return _fit_broadcast(encoded, dimension, settings, iterations, tol, intercept, batches)
    return _fit_distributed(
        encoded, dimension, settings, iterations, tol, broadcast_bytes, intercept, batches
    )
