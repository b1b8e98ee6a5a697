"""Spelling variants: words one edit apart, found by asymmetric chunks.

Of two words the longer one (of equal ones: the smaller) is cut into two
disjoint chunks, the other contributes its positional grams.  One edit leaves a
chunk whole, shifted by at most one place, so the two meet on a chunk.  As the
lengths say what the shift must be, a word has two keys for partners of its own
length and two for partners longer by one.

A chunk that many words share is not joined.  There the rest of the word, the
segment that must hold the edit, is cut into two chunks again, and so on; the
key is then all of the word outside of the segment.  Groups so shrink until
they are small or the segment is one place long, where all members of a group
are near and cannot outnumber the alphabet.  Every pair has one first
difference and is accepted only in the segment that holds it: once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.text import LOWER, byte_set, pieces, words
from clickweave.plans.lookup import BROADCAST_BYTES, fits
from clickweave.plans.scratch import discard, materialize, scratch_path

MIN_LENGTH = 7
MIN_COUNT = 2
# a form must occur this many times as often
FACTOR = 10
# a key with more candidate pairs is cut further
GROUP_PAIRS = 512
# distinct words a task holds before it passes their counts on
_HELD = 200_000

# letters in UTF-8: A-Z, a-z, and U+00C0 to U+00FF, which are 0xC3 and one more byte
_LEAD = 0xC3
_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (_LEAD, _LEAD))


def _long_runs(data: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Start, end, text and code points of runs of letters with at least ``least`` code points."""
    lead = data == _LEAD
    marked = data.copy()
    marked[1:][lead[:-1]] = 0x61
    runs = words(marked, bounds, ~_LETTERS)
    before = np.concatenate(([0], np.cumsum(lead)))
    points = runs.end - runs.start - (before[runs.end] - before[runs.start])
    long = points >= least
    return runs.start[long], runs.end[long], runs.text[long], points[long]


def count_words(docs: DataFrame, *, min_length: int = MIN_LENGTH, typo_every: int | None = None) -> DataFrame:
    """Occurrences (word, n) of runs of letters in the whole texts of ``docs(doc_id, text)``.

    A-Z become lower case.  Words of fewer than ``min_length`` code points are
    left out.  ``typo_every`` spoils words reproducibly: with h the crc32 of
    ``<doc_id>:<word>``, every word whose h it divides loses its code point
    number h % length.  A null id is an empty one there; a null or empty text has
    no words; rows that repeat count again; an empty table gives no rows.
    Frequent words are added up in the map task, so none is a task's own work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            found = [w.decode() for w in held], list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.int64())], ["word", "n"])

        for batch in batches:
            ids = batch.column("id").to_pylist()
            for piece in pieces(batch.column("text")):
                start, end, text, points = _long_runs(piece.data, piece.bounds, min_length)
                raw = LOWER[piece.data].tobytes()
                seeds = [crc32(b"%s:" % (i or "").encode()) for i in ids[piece.first : piece.last]]
                for a, b, t, length in zip(start.tolist(), end.tolist(), text.tolist(), points.tolist()):
                    word = raw[a:b]
                    if typo_every and (h := crc32(word, seeds[t])) % typo_every == 0:
                        if length == min_length:
                            continue
                        whole, at = word.decode(), h % length
                        word = (whole[:at] + whole[at + 1 :]).encode()
                    held[word] = held.get(word, 0) + 1
                if len(held) > _HELD:
                    yield flush()
        yield flush()

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _cut(label: Column, low: Column, high: Column) -> Column:
    """The two halves of a segment."""
    middle = F.floor((low + high) / 2).cast("int")
    return F.array(
        F.struct(label.alias("label"), low.alias("low"), middle.alias("high")),
        F.struct(label.alias("label"), middle.alias("low"), high.alias("high")),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, size, segment) with the key of all of the word outside of its segment.

    ``label`` is the length of the longer word of the pairs that a row is for.
    """
    shift = F.col("label") - F.col("size")
    outside = F.substring("word", F.lit(1), F.col("low")), F.expr("substring(word, high - (label - size) + 1)")
    key = F.xxhash64("label", "low", "high", *outside)
    return rows.select("word", "n", "label", "low", "high", (shift == 0).alias("own"), key.alias("key"))


def _first_rows(vocabulary: DataFrame) -> DataFrame:
    sized = vocabulary.select("word", "n", F.length("word").alias("size"))
    zero = F.lit(0)
    halves = [_cut(F.col("size") + shift, zero, F.col("size") + shift) for shift in (0, 1)]
    return _keyed(sized.select("*", F.inline(F.concat(*halves))))


def _crowded(rows: DataFrame, group_pairs: int) -> DataFrame:
    """Keys with too many candidate pairs whose segment can be cut."""
    counts = rows.groupBy("key").agg(
        F.count_if("own").alias("own"), F.count("*").alias("all"), F.max(F.col("high") - F.col("low")).alias("width")
    )
    return counts.where((F.col("own") * F.col("all") > 2 * group_pairs) & (F.col("width") > 1)).select("key")


def _pairs(rows: DataFrame) -> DataFrame:
    """Pairs of near words (a, n_a, b, n_b) whose first difference lies in the segment of the rows' key."""
    one = rows.where("own").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), "low", "high")
    other = rows.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("own").alias("even"))
    return one.join(other, "key").where(
        """(NOT even OR a < b) AND substring(a, 1, low) = substring(b, 1, low)
           AND substring(a, 1, high) <> substring(b, 1, high) AND levenshtein(a, b, 1) = 1"""
    ).select("a", "n_a", "b", "n_b")


def near_pairs(vocabulary: DataFrame, *, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """All pairs of words of ``vocabulary(word, n)`` one edit apart, each once: (a, n_a, b, n_b).

    ``word`` is unique.  The pairs are written, level by level.
    """
    spark = vocabulary.sparkSession
    rows, path, found = _first_rows(vocabulary), None, []
    while True:
        crowded = materialize(_crowded(rows, group_pairs), "variants-crowded", gone := scratch_path(spark, "variants-crowded"))
        small = fits(crowded, BROADCAST_BYTES)
        keys = F.broadcast(crowded) if small else crowded
        found.append(materialize(_pairs(rows.join(keys, "key", "left_anti")), "variants-pairs"))
        if crowded.isEmpty():
            discard(spark, gone)
            if path:
                discard(spark, path)
            return reduce(DataFrame.unionAll, found)
        held = rows.join(keys, "key", "left_semi").select(
            "word",
            "n",
            F.length("word").alias("size"),
            F.inline(_cut(F.col("label"), F.col("low"), F.col("high"))),
        )
        deeper = scratch_path(spark, "variants-rows")
        rows = materialize(_keyed(held), "variants-rows", deeper)
        discard(spark, gone)
        if path:
            discard(spark, path)
        path = deeper


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: forms followed to the last, twice as far in every round.

    A form is more frequent than its word by a factor, so chains are short and have no rings.
    """
    spark = forms.sparkSession
    path = scratch_path(spark, "variants-roots")
    found = materialize(forms.select("word", F.col("form").alias("root")), "variants-roots", path)
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if found.join(step, "root", "left_semi").isEmpty():
            return found
        after = scratch_path(spark, "variants-roots")
        moved = found.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        found = materialize(moved, "variants-roots", after)
        discard(spark, path)
        path = after


def group_variants(
    counts: DataFrame, *, min_count: int = MIN_COUNT, factor: int = FACTOR, group_pairs: int = GROUP_PAIRS
) -> DataFrame:
    """Group words of ``counts(word, n)`` that are spelling variants of more frequent ones.

    Words with ``n`` under ``min_count`` are left out.  Two are near if one
    inserted, deleted or replaced code point makes one the other.  Returns word,
    n, n_near (number of near words), form (the most frequent near word, ties:
    the first in code-point order, if it occurs ``factor`` times as often or
    more, else null), form_n (its occurrences or null) and root (forms followed
    to the last; the word itself if it has none).  Counts of a word that comes
    in several rows are added; null words are left out; an empty table gives no
    rows; columns other than word and n are ignored.
    """
    vocabulary = counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialize(vocabulary.where(F.col("n") >= min_count), "variants-words")
    pairs = near_pairs(vocabulary, group_pairs=group_pairs)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    near = pairs.select(F.inline(ends)).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    enough = -F.col("best.less") >= F.lit(factor) * F.col("n")
    judged = vocabulary.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    judged = materialize(judged, "variants-judged")
    roots = _roots(judged.where("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
