"""Line deduplication by content-defined chunks of lines."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.spread import spread_lookup
from clickweave.llm.text import SpanHashes, mix, pieces
from clickweave.plans.scratch import discard, materialize, scratch_path

# a chunk ends where the rolling hash over so many lines is 0 modulo the divisor
ROLLING_LINES = 2
DIVISOR = 4
# lists of chunks per document are broadcast to the text scan up to this measured size, else shuffled
BROADCAST_BYTES = 32 << 20
_ROW_BYTES, _ENTRY_BYTES = 64, 64

_NEWLINE = 10
_ROLL = np.uint64(0x9E6C63D0876A9A47)


class Chunks(NamedTuple):
    """Byte spans of the chunks of a piece, without the newline after each; lines and text of each."""

    start: np.ndarray
    end: np.ndarray
    lines: np.ndarray
    text: np.ndarray


def chunks(data: np.ndarray, bounds: np.ndarray, rolling: int, divisor: int) -> Chunks:
    """Cut every text of a piece into chunks of whole lines; an empty text has none."""
    filled = bounds[1:] > bounds[:-1]
    breaks = np.flatnonzero(data == _NEWLINE)
    start = np.sort(np.concatenate((bounds[:-1][filled], breaks + 1)))
    end = np.sort(np.concatenate((breaks, bounds[1:][filled])))
    lines = (np.searchsorted(breaks, bounds[1:]) - np.searchsorted(breaks, bounds[:-1]) + 1) * filled
    text = np.repeat(np.arange(len(lines)), lines)
    first = np.cumsum(lines) - lines
    hashes = SpanHashes(data).of(start, end)
    roll = np.zeros(len(hashes), dtype=np.uint64)
    for back in range(rolling):
        # lines before the first of a text count as 0
        earlier = np.zeros(len(hashes), dtype=np.uint64)
        own = text[back:] == text[: max(0, len(text) - back)]
        earlier[back:][own] = hashes[: max(0, len(hashes) - back)][own]
        roll = roll * _ROLL + earlier
    ends = mix(roll) % np.uint64(divisor) == 0
    ends[(first + lines - 1)[filled]] = True
    last = np.flatnonzero(ends)
    begin = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    return Chunks(start[begin], end[last], last - begin + 1, text[last])


def _spans(batch: pa.RecordBatch, rolling: int, divisor: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buffer of each text and the chunks in it: start, end, lines."""
    for piece in pieces(batch.column("text")):
        found = chunks(piece.data, piece.bounds, rolling, divisor)
        cuts = np.searchsorted(found.text, np.arange(piece.last - piece.first + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            base = piece.bounds[i]
            table = np.stack((found.start[a:b] - base, found.end[a:b] - base, found.lines[a:b]), axis=1)
            yield piece.data[base : piece.bounds[i + 1]], table


def _digests(docs: DataFrame, rolling: int, divisor: int) -> DataFrame:
    """(doc_id, chunk, digest) of every chunk of two lines and more that is not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number, digest = [], [], []
            for i, (data, table) in enumerate(_spans(batch, rolling, divisor)):
                for c in np.flatnonzero(table[:, 2] > 1):
                    text = data[table[c, 0] : table[c, 1]].tobytes()
                    if text.strip():
                        row.append(i)
                        number.append(c)
                        digest.append(hashlib.blake2b(text, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(digest, pa.binary()),
                ],
                ["doc_id", "chunk", "digest"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, chunk int, digest binary")


def _with_lists(docs: DataFrame, lists: DataFrame, column: str, how: str, broadcast_bytes: int) -> DataFrame:
    size = F.sum(F.size(column).cast("bigint") * _ENTRY_BYTES + _ROW_BYTES)
    small = lists.agg(F.coalesce(size, F.lit(0)).alias("bytes")).first()["bytes"] <= broadcast_bytes
    return docs.join(F.broadcast(lists) if small else lists.hint("shuffle_hash"), "doc_id", how)


def _texts(docs: DataFrame, repeated: DataFrame, rolling: int, divisor: int, broadcast_bytes: int) -> DataFrame:
    """(doc_id, chunk, digest, first, body) of repeated chunks, with their bytes."""
    lists = materialize(
        repeated.groupBy("doc_id").agg(F.collect_list(F.struct("chunk", "digest", "first")).alias("found")),
        "line-candidates",
    )
    rows = _with_lists(docs.select("doc_id", "text"), lists, "found", "inner", broadcast_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number, digest, first, body = [], [], [], [], []
            found = batch.column("found").to_pylist()
            for i, (data, table) in enumerate(_spans(batch, rolling, divisor)):
                for f in found[i]:
                    # rows that repeat an id may have other chunks
                    if f["chunk"] >= len(table):
                        continue
                    text = data[table[f["chunk"], 0] : table[f["chunk"], 1]].tobytes()
                    if hashlib.blake2b(text, digest_size=16).digest() != f["digest"]:
                        continue
                    row.append(i)
                    number.append(f["chunk"])
                    digest.append(f["digest"])
                    first.append(f["first"])
                    body.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(digest, pa.binary()),
                    pa.array(first, pa.bool_()),
                    pa.array(body, pa.binary()),
                ],
                ["doc_id", "chunk", "digest", "first", "body"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, chunk int, digest binary, first boolean, body binary")


def line_dedup(
    docs: DataFrame,
    *,
    rolling_lines: int = ROLLING_LINES,
    divisor: int = DIVISOR,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Remove from ``docs(doc_id, text)`` chunks of two and more lines that also occur earlier.

    Returns one row per row: doc_id, n_lines, n_removed (lines) and kept_text.
    A text is cut into chunks where a rolling hash over the last
    ``rolling_lines`` lines is 0 modulo ``divisor``, so lines put in or taken out
    move only the borders near them.  Of equal chunks the one in the smallest
    doc_id, and in it the first, stays.  Single lines and blank chunks are never
    removed.  A null or empty text has no lines.  Rows that repeat a doc_id
    count as one document: what the smallest id holds stays in all its rows.  A
    row without a doc_id stays as it is and counts for no other.  Other columns
    are ignored; an empty table gives no rows.

    Digests find the repeated chunks; equal digests are combined before they
    move.  Only repeated chunks are read again, and each is compared byte by
    byte with the one that stays; a chunk that a third of all documents hold is
    compared in all tasks.
    """
    known = docs.where("doc_id is not null")
    found = materialize(_digests(known, rolling_lines, divisor), "line-chunks")
    groups = found.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "chunk")).alias("keeper")
    )
    groups = materialize(groups.where("n > 1"), "line-groups")
    repeated = spread_lookup(found, groups, "digest", "doc_id").where("n is not null")
    first = F.col("keeper") == F.struct("doc_id", "chunk")
    # rows that repeat a document say the same of its chunks
    repeated = repeated.select("doc_id", "chunk", "digest", first.alias("first")).distinct()
    path = scratch_path(docs.sparkSession, "line-texts")
    bodies = _texts(known, repeated, rolling_lines, divisor, broadcast_bytes)
    # equal chunks of rows that repeat a document are compared once, and combined before they move
    bodies = bodies.groupBy("doc_id", "chunk", "digest", "first").agg(F.min("body").alias("body"))
    bodies = materialize(bodies, "line-texts", path)
    keepers = bodies.where("first").groupBy("digest").agg(F.min("body").alias("kept_body"))
    compared = spread_lookup(bodies.where("not first"), keepers, "digest", "doc_id")
    gone = materialize(
        compared.where("body = kept_body").groupBy("doc_id").agg(F.collect_set("chunk").alias("gone")), "line-gone"
    )
    discard(docs.sparkSession, path)
    rows = _with_lists(docs.select("doc_id", "text"), gone, "gone", "left", broadcast_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, removed, kept = [], [], []
            lists = batch.column("gone").to_pylist()
            for i, (data, table) in enumerate(_spans(batch, rolling_lines, divisor)):
                lines.append(int(table[:, 2].sum()))
                out = [c for c in lists[i] or () if c < len(table)]
                removed.append(int(table[out, 2].sum()))
                if out:
                    stay = np.delete(table, out, axis=0)
                    kept.append(b"\n".join([data[a:b].tobytes() for a, b, _ in stay]).decode())
                else:
                    kept.append(data.tobytes().decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lines, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_lines", "n_removed", "kept_text"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_lines bigint, n_removed bigint, kept_text string")
