"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.spread import tasks
from clickweave.llm.text import WHITE_SPACE, pieces, words
from clickweave.plans.scratch import materialize

CAPACITIES = (512, 1024, 2048, 4096, 8192)
# a sequence costs its length, padding included, and its attention, equal at this length
ATTENTION_EQUALS = 32768
_LOOK_AHEAD = 8


def sequence_cost(capacity: int) -> float:
    return capacity * (1 + capacity / ATTENTION_EQUALS)


class Run(NamedTuple):
    """Bins ``first`` to ``first + count`` (exclusive), all filled alike."""

    first: int
    count: int
    used: int


class Rule(NamedTuple):
    """The next ``count`` pieces of a length: ``per`` to a bin, from bin ``bin`` and offset ``offset`` on."""

    length: int
    rank: int
    count: int
    bin: int
    per: int
    offset: int


class Plan(NamedTuple):
    rules: list[Rule]
    runs: list[Run]


def _cheapest(
    length: int, count: int, capacities: Sequence[int], left: Sequence[int], cost: Callable[[int], float]
) -> int:
    """Bin size that costs least per unit of what it is likely to hold.

    ``left`` are the shorter lengths that still wait, ascending.
    """
    best = (float("inf"), 0)
    for capacity in capacities:
        if capacity < length:
            continue
        held = length * min(count, capacity // length)
        end = len(left)
        for _ in range(_LOOK_AHEAD):
            end = bisect_left(left, capacity - held + 1, 0, end)
            if not end:
                break
            held += left[end - 1]
        final = capacities[bisect_left(capacities, held)]
        # the larger of equals leaves more room for what was not foreseen
        best = min(best, (cost(final) / held, -capacity))
    return -best[1]


def plan_packing(
    lengths: Mapping[int, int],
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> Plan:
    """Best-fit decreasing over counts of lengths instead of single pieces.

    Longest first, each piece goes to the open bin with the least room that
    takes it; if none does, a bin of the least-cost size is opened.  Bins with
    equal contents are handled together, so the plan depends on the number of
    distinct lengths, not of documents: a length splits at most four runs of
    bins, and each visit to a run leaves less than half its room, which bounds
    the rules by 4 x largest capacity x log2(largest capacity).
    """
    capacities = sorted(capacities)
    order = sorted(lengths, reverse=True)
    waiting = order[::-1]
    # open runs by room left; rooms in use as a sorted list
    by_room: dict[int, list[tuple[int, int, int]]] = {}
    rooms: list[int] = []
    rules: list[Rule] = []
    closed: list[Run] = []
    bins = 0

    def add(room: int, first: int, count: int, used: int) -> None:
        if not count:
            return
        if not room:
            closed.append(Run(first, count, used))
        elif room in by_room:
            heapq.heappush(by_room[room], (first, count, used))
        else:
            by_room[room] = [(first, count, used)]
            rooms.insert(bisect_left(rooms, room), room)

    for length in order:
        rank, count = 0, lengths[length]
        waiting.pop()
        while count:
            place = bisect_left(rooms, length)
            if place < len(rooms):
                room = rooms[place]
                first, available, used = heapq.heappop(by_room[room])
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(place)
            else:
                capacity = _cheapest(length, count, capacities, waiting, cost)
                room, used = capacity, 0
                first, available = bins, -(-count // (capacity // length))
                bins += available
            per = room // length
            full = min(available, count // per)
            rest = 0
            if full:
                rules.append(Rule(length, rank, full * per, first, per, used))
                add(room - per * length, first, full, used + per * length)
                rank, count = rank + full * per, count - full * per
            if count and full < available:
                # fewer than fill one bin are left
                rules.append(Rule(length, rank, count, first + full, count, used))
                add(room - count * length, first + full, 1, used + count * length)
                rank, rest, count = rank + count, 1, 0
            add(room, first + full + rest, available - full - rest, used)
    for runs in by_room.values():
        closed += [Run(*run) for run in runs]
    return Plan(rules, sorted(closed))


def word_lengths(docs: DataFrame, *, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Number of words (between white space) of every ``text``: doc (the columns of ``carry``) and length."""
    rest = docs.select("text", F.struct(F.lit(0).alias("_"), *carry).alias("rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.diff(words(p.data, p.bounds, WHITE_SPACE).first) for p in pieces(batch.column("text"))]
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rest"), pa.array(np.concatenate(counts), pa.int64())], ["rest", "length"]
                )

    schema = rest.select("rest").schema.add("length", T.LongType())
    doc = F.struct(*[F.col("rest")[c].alias(c) for c in carry])
    return rest.mapInArrow(run, schema).select(doc.alias("doc"), "length")


def pack_documents(
    lengths: DataFrame,
    *,
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> DataFrame:
    """Assign every row of ``lengths(doc_id, length)`` to sequences of the permitted lengths.

    Returns one row per piece: doc_id, part, start, length, bin_id, capacity and
    offset (place of the piece in its bin).  A document longer than the largest
    capacity is cut into pieces of that capacity and a remainder.  Bins hold no
    more than their capacity, which in the end is the smallest permitted one
    that takes their contents.  A row of length 0 or null keeps one piece
    without a bin (bin_id, capacity and offset null).  Repeated rows are packed
    as often as they come; other columns are ignored; an empty table gives no rows.

    Lengths are counted, the plan is made from the counts on the driver (its
    size is bounded by the largest capacity), and every piece finds its bin from
    its length and its rank among the pieces of that length.  Ranks are counted
    per length and class of ids, so a length that a third of all pieces share is
    spread over all tasks.
    """
    spark = lengths.sparkSession
    sizes = sorted(capacities)
    largest = sizes[-1]
    length = F.coalesce(F.col("length"), F.lit(0)).cast("bigint")
    parts = (
        lengths.select("doc_id", length.alias("_whole"))
        .withColumn("_last", F.greatest(F.lit(0), F.ceil(F.col("_whole") / largest) - 1))
        .select("doc_id", "_whole", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last"))).alias("part"))
        .select(
            "doc_id",
            "part",
            (F.col("part") * largest).alias("start"),
            F.least(F.lit(largest), F.col("_whole") - F.col("part") * largest).alias("length"),
            F.pmod(F.xxhash64("doc_id", "part"), F.lit(tasks(spark))).alias("_class"),
        )
    )
    parts = materialize(parts, "packing-parts")
    counts = materialize(
        parts.where("length > 0").groupBy("length", "_class").agg(F.count(F.lit(1)).alias("n")), "packing-counts"
    )
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = plan_packing({r["length"]: r["n"] for r in totals}, sizes, cost)
    shared = spark.sparkContext.broadcast(_tables(plan, sizes))

    before = Window.partitionBy("length").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_class").orderBy("doc_id", "part")
    ranked = (
        # dealt as the window needs it, so the join costs no exchange of its own
        parts.join(offsets.hint("shuffle_hash"), ["length", "_class"], "left")
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1)
        .select("doc_id", "part", "start", "length", "_rank")
    )
    schema = parts.select("doc_id", "part", "start", "length").schema
    for name in ("bin_id", "capacity", "offset"):
        schema = schema.add(name, T.LongType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _places(
                batch.column("length").to_numpy(), batch.column("_rank").fill_null(0).to_numpy(), shared.value
            )
            columns = [batch.column(n) for n in names[:4]]
            empty = batch.column("length").to_numpy() == 0
            columns += [pa.array(c, pa.int64(), mask=empty) for c in found]
            yield pa.RecordBatch.from_arrays(columns, names)

    return ranked.mapInArrow(run, schema)


class _Tables(NamedTuple):
    rules: np.ndarray
    first: np.ndarray
    capacity: np.ndarray


def _tables(plan: Plan, sizes: Sequence[int]) -> _Tables:
    rules = np.array(sorted(plan.rules), dtype=np.int64).reshape(-1, 6)
    runs = np.array(plan.runs, dtype=np.int64).reshape(-1, 3)
    capacity = np.array(sizes, dtype=np.int64)[np.searchsorted(sizes, runs[:, 2])]
    return _Tables(rules, runs[:, 0], capacity)


def _places(length: np.ndarray, rank: np.ndarray, tables: _Tables) -> list[np.ndarray]:
    """Bin, capacity and offset of pieces, from their length and rank."""
    if not len(tables.rules):
        return [np.zeros(len(length), dtype=np.int64)] * 3
    rules = tables.rules
    # rules are sorted by length, then rank; ranks of a length are below its count
    begin = np.searchsorted(rules[:, 0], length, "left")
    end = np.searchsorted(rules[:, 0], length, "right")
    key = np.cumsum(np.concatenate(([0], rules[:-1, 2])))
    at = np.minimum(begin, len(rules) - 1)
    own = np.searchsorted(key, key[at] + rank, "right") - 1
    own = np.clip(own, at, np.maximum(at, end - 1))
    rule = rules[own]
    nth = rank - rule[:, 1]
    bin_id = rule[:, 3] + nth // rule[:, 4]
    offset = rule[:, 5] + nth % rule[:, 4] * length
    run = np.searchsorted(tables.first, bin_id, "right") - 1
    return [bin_id, tables.capacity[run], offset]
