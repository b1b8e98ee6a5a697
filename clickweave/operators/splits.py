"""Train / validation / test splits, and their cached form."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.hashing import md5_u32
from clickweave.plans.scratch import materialize

SPLITS = ("train", "validation", "test")
WEIGHTS = (0.8, 0.1, 0.1)
SEED = 42


def _cuts(weights: Sequence[float], resolution: int) -> list[int]:
    total = sum(weights)
    return [round(c / total * resolution) for c in accumulate(weights)]


def hash_split(
    df: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    seed: int = SEED,
    names: Sequence[str] = SPLITS,
    key: str = "obs_id",
) -> DataFrame:
    """Add ``split``: a pure function of seed and key.

    Unlike a sampler it gives the same answer for every partitioning, retry
    and file layout, so no split has to be stored to stay disjoint.
    """
    draw = md5_u32(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    cuts = _cuts(weights, 1 << 32)
    choice = F.when(F.col("_u") < cuts[0], names[0])
    for cut, name in zip(cuts[1:-1], names[1:-1]):
        choice = choice.when(F.col("_u") < cut, name)
    return df.withColumn("_u", draw).withColumn("split", choice.otherwise(names[-1])).drop("_u")


def random_split(
    df: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED, names: Sequence[str] = SPLITS
) -> dict[str, DataFrame]:
    """Seeded random parts.

    Every row draws once and the draws are written, so the parts cover the rows
    and stay disjoint whatever is recomputed; which rows are drawn depends on the
    partitioning of the input.
    """
    cuts = _cuts(weights, 1 << 32)
    draw = F.floor(F.rand(seed) * F.lit(1 << 32))
    part = F.lit(0)
    drawn = materialize(df.withColumn("_u", draw), "random-split")
    for cut in cuts[:-1]:
        part = part + (F.col("_u") >= cut).cast("int")
    return {name: drawn.where(part == k).drop("_u") for k, name in enumerate(names)}


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split in one job."""
    return df.groupBy("split").agg(F.count("*").alias("n"))


class CachedSplits:
    """Owner of rows that are used several times, by split.

    ``df`` carries ``split``.  The rows are computed once, at the first use, and
    kept under one storage level, ordered by split within each partition, so that a
    read of one split passes over the cached batches of the others.  Partitions
    lost with an executor, or dropped for want of room, are computed again.
    Leaving the ``with`` block releases everything; a split asked for later is
    an error, as it would quietly compute the rows anew.
    """

    def __init__(
        self, df: DataFrame, names: Sequence[str] = SPLITS, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
    ):
        self.names = list(names)
        self.level = level
        self._rows: DataFrame | None = df.sortWithinPartitions("split").persist(level)

    def __enter__(self) -> CachedSplits:
        return self

    def __exit__(self, *raised) -> None:
        self.release()

    @property
    def rows(self) -> DataFrame:
        """All rows, cached."""
        if self._rows is None:
            raise RuntimeError("the splits have been released")
        return self._rows

    def __getitem__(self, name: str) -> DataFrame:
        """The cached rows of one split."""
        if name not in self.names:
            raise KeyError(f"no split {name!r} among {self.names}")
        return self.rows.where(F.col("split") == name)

    def is_cached(self, name: str) -> bool:
        """Whether a use of the split reads the cache, as Spark itself plans it."""
        if self._rows is None or self._rows.storageLevel == StorageLevel.NONE:
            return False
        return "InMemoryRelation" in self[name]._jdf.queryExecution().withCachedData().toString()

    def counts(self) -> DataFrame:
        """``(split, n, is_cached)``, one row per name, also for splits without rows; fills the cache."""
        spark = self.rows.sparkSession
        rows = [(i, name, self.is_cached(name)) for i, name in enumerate(self.names)]
        known = spark.createDataFrame(rows, "_i int, split string, is_cached boolean")
        counted = known.join(split_counts(self.rows), "split", "left").orderBy("_i")
        return counted.select("split", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "is_cached")

    def release(self) -> None:
        """Free the memory; a second call does nothing."""
        if self._rows is not None:
            self._rows.unpersist(blocking=True)
            self._rows = None
