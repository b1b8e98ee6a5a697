"""Global order without a single-partition window.

Both functions range-partition the rows (equal work per task), number or sum
inside each range, and shift every range by the total of the ranges before it.
Only one small row per *partition* ever reaches the driver.  The range a row
landed in is frozen by writing it out, so a retried or re-planned job cannot
disagree with the totals.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.plans.scratch import materialize

# monotonically_increasing_id() keeps the row position in its low 33 bits
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def _before(totals: Mapping[int, int | float], part: Column, kind: str) -> Column:
    """What all ranges before the given one add up to: one literal number per range."""
    last = max(totals, default=0)
    sums = accumulate((totals.get(pid, 0) for pid in range(last)), initial=0)
    literal = F.split(F.lit(",".join(map(repr, sums))), ",").cast(f"array<{kind}>")
    return F.get(literal, part)


def dense_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """Add a 0-based dense index in the given order (rows must be distinct on it)."""
    row_id = F.monotonically_increasing_id()
    numbered = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", row_id.alias("_row")),
        "dense-index",
    ).withColumn("_part", F.shiftright("_row", _POSITION_BITS).cast("int"))
    totals = {r["_part"]: r["n"] for r in numbered.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    position = F.col("_row").bitwiseAND(F.lit(_POSITION_MASK))
    return numbered.select(*df.columns, (_before(totals, F.col("_part"), "bigint") + position).alias(name))


def _accumulate(sums: Mapping[str, str]):
    """Task function: running sums over the rows of one range, which come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = {name: 0 for name in sums}
        for batch in batches:
            columns, names = list(batch.columns), list(batch.schema.names)
            for name, source in sums.items():
                total = np.cumsum(batch.column(source).fill_null(0).to_numpy()) + before[name]
                before[name] = total[-1] if len(total) else before[name]
                columns.append(pa.array(total))
                names.append(f"_sum_{name}")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def running_totals(df: DataFrame, order: Sequence[Column], sums: Mapping[str, str]) -> DataFrame:
    """Add inclusive running sums along a global order.

    ``sums`` maps each new column to the (bigint or double) column it
    accumulates.  ``order`` must be a total order (break ties with a key).  Rows
    are shuffled once, into ranges; each range is summed where it is, written
    with its number, and shifted by the totals of the ranges before it.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    inputs = {f"_in_{n}": F.col(c).cast(_wide(df.schema[c].dataType)) for n, c in sums.items()}
    ranged = ranged.withColumns(inputs)
    added = [T.StructField(f"_sum_{name}", ranged.schema[f"_in_{name}"].dataType) for name in sums]
    schema = T.StructType([*ranged.schema.fields, *added])
    summed = ranged.mapInArrow(_accumulate({n: f"_in_{n}" for n in sums}), schema).drop(*inputs)
    ranged = materialize(summed.withColumn("_part", F.spark_partition_id()), "running-totals")
    totals = ranged.groupBy("_part").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()])
    rows = totals.collect()
    running = [
        _before({r["_part"]: r[n] for r in rows}, F.col("_part"), totals.schema[n].dataType.simpleString())
        + F.col(f"_sum_{n}")
        for n in sums
    ]
    return ranged.select(*df.columns, *[total.alias(n) for total, n in zip(running, sums)])


def _wide(kind: T.DataType) -> T.DataType:
    """The type that sums of a column have."""
    return T.DoubleType() if isinstance(kind, (T.DoubleType, T.FloatType)) else T.LongType()
