"""Substring deduplication by relative Lempel-Ziv parsing against an index of repeated windows."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.spread import tasks
from clickweave.llm.text import WHITE_SPACE, Words, pieces, window_hashes, word_hashes, words

WINDOW_WORDS = 20
# a window is found by the smallest hash among its runs of this many words
ANCHOR_WORDS = 8
_NO_ID = np.iinfo(np.int64).max
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_FACTORS = "array<struct<start:int,end:int,source_id:bigint,source_start:int>>"
_FACTOR_TYPE = pa.list_(
    pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("source_id", pa.int64()), ("source_start", pa.int32())]
    )
)


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """Least or greatest of every ``n`` neighbours."""
    width = 1
    while width * 2 <= n:
        values = pick(values[:-width], values[width:])
        width *= 2
    if width < n:
        values = pick(values[: len(values) - (n - width)], values[n - width :])
    return values


class _Piece(NamedTuple):
    """The words of a piece; first word and anchor of each window; all anchors."""

    data: np.ndarray
    words: Words
    hashes: np.ndarray
    at: np.ndarray
    least: np.ndarray
    anchors: np.ndarray


def _read(data: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> _Piece:
    found = words(data, bounds, WHITE_SPACE)
    hashes = word_hashes(data, found.start, found.end)
    none = np.zeros(0, dtype=np.uint64)
    span = window - anchor + 1
    if len(hashes) < window:
        return _Piece(data, found, hashes, np.zeros(0, dtype=np.int64), none, none)
    grams, at = window_hashes(hashes, found.text, anchor)
    value = np.full(len(hashes) - anchor + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    value[at] = grams
    least = _sliding(value, span, np.minimum)
    whole = found.text[: len(least)] == found.text[window - 1 :]
    # an anchor is a gram that is the least of some window; equal windows have equal anchors
    top = np.concatenate((np.zeros(span - 1, np.uint64), np.where(whole, least, 0), np.zeros(span - 1, np.uint64)))
    anchors = value[_sliding(top, span, np.maximum) == value]
    at = np.flatnonzero(whole)
    return _Piece(data, found, hashes, at, least[at], anchors)


def _in_order(table: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """Ids (null: after all others) and rows of a unit by id; rows of one id by text."""
    ids = table.column("doc_id").fill_null(_NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    same = ids[order][1:] == ids[order][:-1]
    if same.any():
        texts = table.column("text").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] or "")))
    return ids[order], table.take(order)


def _pieces(table: pa.Table, window: int, anchor: int) -> Iterator[tuple[int, _Piece]]:
    """Row number of the first text of each piece, and the piece."""
    for piece in pieces(table.column("text")):
        yield piece.first, _read(piece.data, piece.bounds, window, anchor)


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    place = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[place] == values


class _Windows(NamedTuple):
    """Windows of a unit whose anchor is repeated, in order of (id, position)."""

    row: np.ndarray
    at: np.ndarray
    high: np.ndarray
    low: np.ndarray


def _repeated_windows(
    table: pa.Table, ids: np.ndarray, repeated: np.ndarray, window: int, anchor: int
) -> _Windows:
    row, at, high, low = [], [], [], []
    for first, piece in _pieces(table, window, anchor):
        chosen = piece.at[_member(piece.least, repeated)]
        whole, where = window_hashes(piece.hashes, piece.words.text, window)
        other, _ = window_hashes(piece.hashes ^ _SECOND, piece.words.text, window)
        place = np.searchsorted(where, chosen)
        text = piece.words.text[chosen]
        row.append(first + text)
        at.append((chosen - piece.words.first[text]).astype(np.int32))
        high.append(whole[place])
        low.append((other[place] >> np.uint64(32)).astype(np.uint32))
    if not row:
        return _Windows(*[np.zeros(0, dtype=d) for d in (np.int64, np.int32, np.uint64, np.uint32)])
    found = _Windows(*[np.concatenate(x) for x in (row, at, high, low)])
    if (ids[1:] == ids[:-1]).any():
        order = np.lexsort((found.at, ids[found.row]))
        found = _Windows(*[x[order] for x in found])
    return found


def _distinct(w: _Windows) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence of every distinct window, in order, and the number of each window among those."""
    order = np.argsort(w.high, kind="stable")
    same = w.high[order][1:] == w.high[order][:-1]
    if (same & (w.low[order][1:] != w.low[order][:-1])).any():
        order = np.lexsort((w.low, w.high))
        same = (w.high[order][1:] == w.high[order][:-1]) & (w.low[order][1:] == w.low[order][:-1])
    begin = np.concatenate(([True], ~same)) if len(order) else np.zeros(0, dtype=bool)
    first = order[begin]
    rank = np.empty(len(first), dtype=np.int64)
    by_place = np.argsort(first)
    rank[by_place] = np.arange(len(first))
    number = np.empty(len(order), dtype=np.int64)
    number[order] = rank[np.cumsum(begin) - 1]
    return first[by_place], number


def _joined(blobs: list[bytes], kind) -> np.ndarray:
    blob = b"".join(blobs)
    return np.frombuffer(blob, dtype=kind) if blob else np.zeros(0, dtype=kind)


def _table(names: dict[str, pa.DataType], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table({n: pa.array(list(c), t) for (n, t), c in zip(names.items(), columns)})


def _by_bucket(values: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Places of the values of every bucket, in order."""
    to = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(buckets + 1))
    return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _anchors(window: int, anchor: int, buckets: int):
    """Distinct anchors of a unit, and which of them it has more than once."""
    names = {"bucket": pa.int32(), "unit": pa.int32(), "anchors": pa.binary(), "several": pa.binary()}

    def run(table: pa.Table) -> pa.Table:
        unit = table.column("unit")[0].as_py()
        found = [piece.anchors for _, piece in _pieces(table, window, anchor)]
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        several = counts > 1
        return _table(
            names,
            [
                (b, unit, values[i].tobytes(), several[i].tobytes())
                for b, i in enumerate(_by_bucket(values, buckets))
                if len(i)
            ],
        )

    return run


_ANSWER = {"unit": pa.int32(), "bucket": pa.int32(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary()}
_ANSWER_SCHEMA = "unit int, bucket int, a binary, b binary, c binary"


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """Tell every unit which of its anchors occur more than once anywhere."""
    parts = [np.frombuffer(b, np.uint64) for b in table.column("anchors").to_pylist()]
    several = _joined(table.column("several").to_pylist(), np.bool_)
    values, numbers = np.unique(np.concatenate(parts), return_inverse=True)
    repeated = np.bincount(numbers, weights=1 + several) > 1
    rows, at = [], 0
    for unit, part in zip(table.column("unit").to_pylist(), parts):
        own = part[repeated[numbers[at : at + len(part)]]]
        at += len(part)
        if len(own):
            rows.append((unit, -1, own.tobytes(), b"", b""))
    return _table(_ANSWER, rows)


def _unit_windows(window: int, anchor: int, buckets: int):
    """First occurrence in the unit of each distinct window with a repeated anchor."""
    names = {"bucket": pa.int32(), "unit": pa.int32()} | {n: pa.binary() for n in ("high", "low", "ids", "at")}

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table) or not len(answers):
            return _table(names, [])
        ids, table = _in_order(table)
        repeated = np.sort(_joined(answers.column("a").to_pylist(), np.uint64))
        found = _repeated_windows(table, ids, repeated, window, anchor)
        first, _ = _distinct(found)
        unit = table.column("unit")[0].as_py()
        high, low, at, own = found.high[first], found.low[first], found.at[first], ids[found.row[first]]
        return _table(
            names,
            [
                (b, unit, high[i].tobytes(), low[i].tobytes(), own[i].tobytes(), at[i].tobytes())
                for b, i in enumerate(_by_bucket(high, buckets))
                if len(i)
            ],
        )

    return run


def _sources(table: pa.Table) -> pa.Table:
    """Earliest occurrence of each window over all units; told to the units that do not hold it."""
    lengths = [len(b) // 4 for b in table.column("low").to_pylist()]
    high, low, ids, at = (
        _joined(table.column(n).to_pylist(), k)
        for n, k in (("high", np.uint64), ("low", np.uint32), ("ids", np.int64), ("at", np.int32))
    )
    order = np.lexsort((at, ids, low, high))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    source = np.empty(len(order), dtype=np.int64)
    source[order] = order[new][np.cumsum(new) - 1]
    later = (ids != ids[source]) | (at != at[source])
    rows, begin = [], 0
    for unit, bucket, length in zip(table.column("unit").to_pylist(), table.column("bucket").to_pylist(), lengths):
        own = np.flatnonzero(later[begin : begin + length])
        if len(own):
            there = source[begin + own]
            shift = at[there] - at[begin + own]
            rows.append((unit, bucket, own.astype(np.int32).tobytes(), ids[there].tobytes(), shift.tobytes()))
        begin += length
    return _table(_ANSWER, rows)


def _parse(starts: np.ndarray, source: np.ndarray, shift: np.ndarray, window: int) -> list[dict]:
    """Factors of one document: stretches of windows that follow one earlier place."""
    if not len(starts):
        return []
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (np.diff(starts) != 1) | (source[1:] != source[:-1]) | (shift[1:] != shift[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(starts)) - 1
    return [
        {
            "start": int(starts[a]),
            "end": int(starts[b]) + window,
            "source_id": None if source[a] == _NO_ID else int(source[a]),
            "source_start": int(starts[a] + shift[a]),
        }
        for a, b in zip(begin, end)
    ]


def _factor(window: int, anchor: int, buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = {"doc_id": table.schema.field("doc_id").type, "n_words": pa.int64(), "n_removed": pa.int64()}
        names |= {"kept_text": pa.string(), "factors": _FACTOR_TYPE}
        if not len(table):
            return _table(names, [])
        ids, table = _in_order(table)
        about = list(zip(*[answers.column(n).to_pylist() for n in ("bucket", "a", "b", "c")]))
        repeated = np.sort(_joined([a for bucket, a, _, _ in about if bucket < 0], np.uint64))
        found = _repeated_windows(table, ids, repeated, window, anchor)
        first, number = _distinct(found)
        # the earliest place of each distinct window: here, unless a bucket tells of another
        source = ids[found.row[first]]
        source_at = found.at[first].copy()
        dealt = _by_bucket(found.high[first], buckets)
        for bucket, own, there, moved in about:
            if bucket >= 0:
                i = dealt[bucket][np.frombuffer(own, np.int32)]
                source[i] = np.frombuffer(there, np.int64)
                source_at[i] += np.frombuffer(moved, np.int32)
        source, source_at = source[number], source_at[number]
        later = np.flatnonzero((source != ids[found.row]) | (source_at != found.at))
        later = later[np.argsort(found.row[later], kind="stable")]
        row, at, source, source_at = found.row[later], found.at[later], source[later], source_at[later]
        shift = source_at - at
        cuts = np.searchsorted(row, np.arange(len(ids) + 1))
        rows = []
        id_list = table.column("doc_id").to_pylist()
        for base, piece in _pieces(table, window, anchor):
            data, spans = piece.data, piece.words
            for i in range(len(spans.first) - 1):
                a, b = cuts[base + i], cuts[base + i + 1]
                factors = _parse(at[a:b], source[a:b], shift[a:b], window)
                begin, end = int(spans.first[i]), int(spans.first[i + 1])
                gone = np.zeros(end - begin + 1, dtype=np.int32)
                for f in factors:
                    gone[f["start"]] += 1
                    gone[f["end"]] -= 1
                keep = begin + np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                kept = b" ".join([data[s:e].tobytes() for s, e in zip(spans.start[keep], spans.end[keep])])
                rows.append((id_list[base + i], end - begin, end - begin - len(keep), kept.decode(), factors))
        return _table(names, rows)

    return run


def substring_dedup(
    docs: DataFrame, *, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS
) -> DataFrame:
    """Remove from ``docs(doc_id, text)`` every word inside ``window`` words that also start earlier.

    Returns one row per row: doc_id, n_words, n_removed, kept_text (kept words
    joined by single spaces) and factors (word spans with the earlier place
    each repeats).  Words are what stands between white space.  Earlier means a
    smaller doc_id, or the same doc_id and an earlier word; a null doc_id comes
    after all others.  Rows that repeat a doc_id share its positions, so a
    repeated row removes nothing from itself.  Documents are judged as they
    came in.  A null or empty text has no words; other columns are ignored; an
    empty table gives no rows.

    Documents are dealt into units by id, and their text moves once.  The
    smallest hash of the word runs inside a window is its anchor; units tell
    buckets of anchors which they have, and only windows whose anchor occurs
    twice anywhere are indexed.  Each unit sends one occurrence of such a window
    to its bucket and learns of the earliest one elsewhere.  A document is then
    parsed into stretches of windows whose earliest places follow each other: a
    stretch ends where the earliest place changes, even if another earlier place
    matches on, so it need not be the longest match.  Windows are equal if 96 bits
    of their hashes are; words are not compared.  Windows across the border of two
    stretches are looked up like all others.
    """
    parts = tasks(docs.sparkSession)
    units = 2 * parts
    dealt = docs.select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(units)).cast("int").alias("unit")
    ).repartition(parts, "unit")
    by_unit = dealt.groupBy("unit")
    repeated = (
        by_unit.applyInArrow(
            _anchors(window, anchor, parts), "bucket int, unit int, anchors binary, several binary"
        )
        .groupBy("bucket")
        .applyInArrow(_repeated_anchors, _ANSWER_SCHEMA)
    )
    sources = (
        by_unit.cogroup(repeated.groupBy("unit"))
        .applyInArrow(
            _unit_windows(window, anchor, parts),
            "bucket int, unit int, high binary, low binary, ids binary, at binary",
        )
        .groupBy("bucket")
        .applyInArrow(_sources, _ANSWER_SCHEMA)
    )
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType.fromDDL(
        f"doc_id {id_type.simpleString()}, n_words bigint, n_removed bigint, kept_text string, factors {_FACTORS}"
    )
    answers = repeated.unionByName(sources).groupBy("unit")
    return by_unit.cogroup(answers).applyInArrow(_factor(window, anchor, parts), schema)
