"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.text import LOWER, Words, byte_set, mix, pieces, word_hashes, words
from clickweave.plans.scratch import materialize

WINDOW_WORDS = 10
# benchmark text per search pass (its tables take some 60 times that); more text is searched for in further
# passes over the same rows, so many of them in one stage
BLOCK_BYTES = 2 << 20
PASSES_PER_STAGE = 3
# cursors advance over stretches of this many windows, all stretches of a piece at once
STRETCH = 256
_BLOCK_FACTOR = np.uint64(0x9FB21C651E98DF25)

# everything in ASCII that is neither a digit nor, after lower-casing, a letter
SEPARATORS = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ITEMS = pa.list_(pa.string())


class _Text(NamedTuple):
    data: np.ndarray
    words: Words
    hashes: np.ndarray

    def normal(self, first: int, last: int) -> bytes:
        """Words first to last (exclusive) with single spaces."""
        w = self.words
        return b" ".join(self.data[w.start[i] : w.end[i]].tobytes() for i in range(first, last))


def _read(data: np.ndarray, bounds: np.ndarray) -> _Text:
    data = LOWER[data]
    found = words(data, bounds, SEPARATORS)
    return _Text(data, found, word_hashes(data, found.start, found.end))


class _Search:
    """All patterns of one length: shift table, suffix buckets, texts to compare with."""

    def __init__(self, length: int, patterns: dict[bytes, tuple[str, ...]]):
        self.length = length
        self.block = min(2, length)
        texts = list(patterns)
        joined = np.frombuffer(b" ".join(texts), np.uint8)
        rows = _read(joined, np.array([0, len(joined)])).hashes.reshape(-1, length)
        suffix = self._blocks(rows, np.full(len(rows), length - 1))
        order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[order]
        self.rows = rows[order]
        self.texts = [texts[i] for i in order]
        self.items = [patterns[t] for t in self.texts]
        bits = max(16, int(len(rows) * length * 4).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        # how far the window may move when it ends in a block: to the last place any pattern has it
        self.shift = np.full(1 << bits, length - self.block + 1, dtype=np.int64)
        for end in range(self.block - 1, length):
            slots = (self._blocks(rows, np.full(len(rows), end)) & self.mask).astype(np.int64)
            np.minimum.at(self.shift, slots, length - 1 - end)

    def _blocks(self, rows: np.ndarray, end: np.ndarray) -> np.ndarray:
        at = np.arange(len(rows))
        last = rows[at, end]
        return mix(last) if self.block == 1 else mix(rows[at, end - 1] * _BLOCK_FACTOR + last)

    def find(self, text: _Text) -> Iterator[tuple[int, int]]:
        """(number of the first word, number of the pattern) of every occurrence."""
        first, hashes, m = text.words.first, text.hashes, self.length
        ends, stops = first[:-1] + m - 1, first[1:]
        counts = np.maximum(0, -(-(stops - ends) // STRETCH))
        owner = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = ends[owner] + step * STRETCH
        stop = np.minimum(at + STRETCH, stops[owner])
        while len(at):
            block = mix(hashes[at]) if self.block == 1 else mix(hashes[at - 1] * _BLOCK_FACTOR + hashes[at])
            move = self.shift[(block & self.mask).astype(np.int64)]
            low = np.searchsorted(self.suffix, block, "left")
            high = np.searchsorted(self.suffix, block, "right")
            for c in np.flatnonzero((move == 0) & (high > low)):
                begin = int(at[c]) - m + 1
                same = (self.rows[low[c] : high[c]] == hashes[begin : begin + m]).all(axis=1)
                for k in np.flatnonzero(same) + low[c]:
                    if text.normal(begin, begin + m) == self.texts[k]:
                        yield begin, int(k)
            at = at + np.maximum(move, 1)
            open_ = at < stop
            at, stop = at[open_], stop[open_]


def _searches(rows: Iterable[tuple[str | None, str | None]], window: int) -> list[_Search]:
    rows = [(item, text) for item, text in rows if text]
    lengths: dict[int, dict[bytes, tuple[str, ...]]] = {}
    for piece in pieces(pa.array([t for _, t in rows], pa.string())):
        text = _read(piece.data, piece.bounds)
        for i in range(piece.last - piece.first):
            begin, end = int(text.words.first[i]), int(text.words.first[i + 1])
            m = min(window, end - begin)
            if not m:
                continue
            patterns = lengths.setdefault(m, {})
            for at in range(begin, end - m + 1):
                passage, item = text.normal(at, at + m), rows[piece.first + i][0]
                items = patterns.setdefault(passage, ())
                if item is not None and item not in items:
                    patterns[passage] = (*items, item)
    return [_Search(m, patterns) for m, patterns in sorted(lengths.items())]


def _merged(marks: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks, [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def _scan(batch: pa.RecordBatch, searches: list[_Search]) -> tuple[list[int], list[list[dict]], list[list[str]]]:
    """Per text: its words, the word spans inside any occurrence, the items that occur."""
    n_words, spans, items = [], [], []
    for piece in pieces(batch.column("text")):
        text = _read(piece.data, piece.bounds)
        count = piece.last - piece.first
        cover = np.zeros(len(text.hashes) + 1, dtype=np.int64)
        found: dict[int, set[str]] = {}
        for search in searches:
            for begin, k in search.find(text):
                cover[begin] += 1
                cover[begin + search.length] -= 1
                found.setdefault(int(text.words.text[begin]), set()).update(search.items[k])
        marks = (np.cumsum(cover[:-1]) > 0).astype(np.int8)
        first = text.words.first
        n_words += np.diff(first).tolist()
        spans += [_merged(marks[first[i] : first[i + 1]]) if i in found else [] for i in range(count)]
        items += [sorted(found.get(i, ())) for i in range(count)]
    return n_words, spans, items


def _union(one: list[dict], other: list[dict]) -> list[dict]:
    merged: list[dict] = []
    for span in sorted(one + other, key=lambda s: s["start"]):
        if merged and span["start"] <= merged[-1]["end"]:
            merged[-1]["end"] = max(merged[-1]["end"], span["end"])
        else:
            merged.append(dict(span))
    return merged


def _pass(
    rows: DataFrame, patterns: list[tuple[str | None, str | None]], window: int, keep_text: bool
) -> DataFrame:
    """Search every row for one block of the benchmark and add to what earlier passes found."""
    shared = rows.sparkSession.sparkContext.broadcast(patterns)
    kept = ["rest", "text"] if keep_text else ["rest"]
    schema = rows.select(*kept).schema
    for field in T.StructType.fromDDL(
        "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"
    ):
        schema = schema.add(field)
    names = schema.names

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = None
        for batch in batches:
            searches = searches if searches is not None else _searches(shared.value, window)
            n_words, spans, items = _scan(batch, searches)
            if "spans" in batch.schema.names:
                spans = [_union(a, b) for a, b in zip(batch.column("spans").to_pylist(), spans)]
                items = [sorted({*a, *b}) for a, b in zip(batch.column("items").to_pylist(), items)]
            columns = [
                *[batch.column(name) for name in kept],
                pa.array(n_words, pa.int64()),
                pa.array(spans, _SPANS),
                pa.array(items, _ITEMS),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(search, schema)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    carry: Sequence[str] = ("doc_id",),
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Where the passages of ``benchmark(item_id, text)`` occur in ``docs(doc_id, text)``.

    Returns one row per row of ``docs``: doc (a struct of the columns named in
    ``carry``), n_words, spans (word numbers inside any occurrence, end
    exclusive, merged) and items (sorted distinct item ids as strings).  Words are runs of digits, letters and
    non-ASCII characters after lower-casing A-Z.  A passage is ``window``
    consecutive words of an item, or a whole item that is shorter.  A null or
    empty text has no words; items without words never occur; an item without
    an id marks words but is not listed; repeated items count once; columns not
    carried are ignored.  Empty tables give no rows, or rows without spans.

    Wu-Manber over words: a table tells, for the two words under a window's end,
    how far the window can move; where it cannot, patterns with that suffix are
    compared, first by hash and then byte by byte.  No row moves between tasks.
    The benchmark is a query set: it is sent to the tasks in blocks of about
    ``block_bytes``, each block being one more pass; after every few passes the
    rows are written, so the tables that a task holds stay bounded.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    total = benchmark.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = max(1, -(-total // block_bytes))
    own = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"),
        "text",
        F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"),
    )
    rest = [c for c in carry if c != "text"]
    found = docs.select("text", F.struct(F.lit(0).alias("_"), *rest).alias("rest"))
    for block in range(blocks):
        rows = own.where(F.col("block") == block).select("item_id", "text").collect()
        keep_text = "text" in carry or block < blocks - 1
        found = _pass(found, [tuple(r) for r in rows], window, keep_text)
        if block % PASSES_PER_STAGE == PASSES_PER_STAGE - 1 and block < blocks - 1:
            found = materialize(found, "benchmark-passes")
    doc = F.struct(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in carry])
    return found.select(doc.alias("doc"), "n_words", "spans", "items")


def hit_words(spans: Column) -> Column:
    """Number of words inside spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]))
