"""Personal data: fixed patterns, and a skip-chain conditional random field that tags further mentions."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.skipchain import (
    REPEAT,
    SIMILAR,
    Edges,
    SkipChain,
    chain_edges,
    decode,
    fit_skip_chain,
    join_edges,
    skip_edges,
)
from clickweave.llm.text import LOWER, Span, SpanHashes, apart, byte_set, pieces, words
from clickweave.plans.scratch import discard, materialize, scratch_path

# texts the tagger learns from, those that hash lowest: of texts that may hold personal data, and of the others
SAMPLE_LIKELY, SAMPLE_OTHER = 400, 300
# spans of a sampled text that are learned from, evenly spread over it, and characters around each
SPANS_PER_TEXT, AROUND = 6, 60
# other extracts of a text
OTHER_WINDOWS = 4

BASE_KINDS = ("email", "ip", "card", "phone")
# label 0 is no personal data; label 1 + k is of base kind k
KINDS = (*BASE_KINDS, *[f"tagged_{k}" for k in BASE_KINDS])

# fixed values: the patterns, and the least and largest numbers of digits
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IP_LARGEST, _CARD_DIGITS, _PHONE_DIGITS = 255, (12, 19), (9, 15)
# texts that may match hold an at sign or a number like these
_LIKELY = "[0-9][0-9. -]{6}"

_DIGITS, _NOT_DIGITS = "0123456789", re.compile(r"[^0-9]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(_DOUBLED[int(d)] for d in even)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns, leftmost first and not overlapping per kind, in time linear in the text."""
    out, end = [], 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            out.append(Span(start, 0, end))
    for m in _IP.finditer(text):
        # long parts are told by their digits alone
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= _IP_LARGEST for p in parts):
            out.append(Span(m.start(), 1, m.end()))
    least, most = _CARD_DIGITS
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= least:
            digits = _NOT_DIGITS.sub("", m[0])
            if least <= len(digits) <= most and luhn(digits):
                out.append(Span(m.start(), 2, m.end()))
    least, most = _PHONE_DIGITS
    for m in _PHONE.finditer(text) if "+" in text else ():
        if least <= len(_NOT_DIGITS.sub("", m[0])) <= most:
            out.append(Span(m.start(), 3, m.end()))
    return sorted(out)


# ------------------------------------------------------------------ tokens and their features

# tokens are runs of letters and digits, and of all that is not ASCII
_SEPARATORS = ~byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_CLASSES = [byte_set((0x30, 0x39)), byte_set((0x41, 0x5A)), byte_set((0x61, 0x7A)), byte_set((0x80, 0xFF))]
_DIGIT, _UPPER = 0, 1
_SHAPES = 1 << len(_CLASSES)
_LENGTHS = np.array([2, 3, 4, 5, 6, 8, 10, 12, 14, 16, 17, 20, 32])
_FORMS = _SHAPES * (len(_LENGTHS) + 1)
# what stands between two tokens: which of these, or anything else
_MARKS = [
    byte_set((0x40, 0x40)),
    byte_set((0x2E, 0x2E)),
    byte_set((0x2B, 0x2B)),
    byte_set((0x28, 0x29), (0x2D, 0x2D), (0x5F, 0x5F)),
    byte_set((0x20, 0x20)),
]
_ELSE = ~np.any(_MARKS, axis=0)
# one bit per class, and per mark, of every byte
_CLASS_BITS = sum(table.astype(np.uint8) << i for i, table in enumerate(_CLASSES)).astype(np.uint8)
_MARK_BITS = sum(table.astype(np.uint8) << i for i, table in enumerate([*_MARKS, _ELSE])).astype(np.uint8)
_GAPS = 1 << (len(_MARKS) + 1)
# digits of neighbouring numbers belong together over gaps of these, up to this many
_JOINTS, _JOINT_LENGTH = ~byte_set((0x20, 0x20), (0x28, 0x29), (0x2D, 0x2E)), 3
_CHAIN_DIGITS = 24
_WORD_BITS = 12
# tokens with a digit are alike in their last characters, others in their first ones
_LIKE = 4, 6

# values of each feature: form; gaps before and after; forms and words of the neighbours; gap before the previous token
# and shape; digits of the number and its checksum
_WIDTHS = [
    _FORMS,
    _GAPS * _GAPS,
    _FORMS + 1,
    _FORMS + 1,
    1 << _WORD_BITS,
    1 << _WORD_BITS,
    _GAPS * _SHAPES,
    2 * (_CHAIN_DIGITS + 1),
]


def _sums(marks: np.ndarray) -> np.ndarray:
    out = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=out[1:])
    return out


def _bits(padded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All bits of ``padded[start:end]`` together, per span; ``padded`` has one byte too many."""
    borders = np.empty(2 * len(start), np.int64)
    borders[0::2], borders[1::2] = start, end
    if not len(borders):
        return np.zeros(0, np.int64)
    found = np.bitwise_or.reduceat(padded, borders)[::2].astype(np.int64)
    found[start >= end] = 0
    return found


class _Tokens:
    """Tokens of a piece with their features and edges."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.found = found = words(data, bounds, _SEPARATORS)
        start, end, text = found.start, found.end, found.text
        n = len(start)
        padded = np.append(data, np.uint8(0))
        shape = _bits(_CLASS_BITS[padded], start, end)
        form = shape * (len(_LENGTHS) + 1) + np.searchsorted(_LENGTHS, end - start, "right")
        first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        filled = found.first[1:] > found.first[:-1]
        first[found.first[:-1][filled]] = True
        last[found.first[1:][filled] - 1] = True
        before = np.concatenate(([0], end[:-1])) if n else np.zeros(0, np.int64)
        before[first] = bounds[text[first]]
        marks = _MARK_BITS[padded]
        gap = _bits(marks, before, start)
        after = np.append(gap[1:], 0) if n else gap
        after[last] = _bits(marks, end[last], bounds[text[last] + 1])
        self.gap = start - before
        spans = SpanHashes(LOWER[data])
        hashes = spans.of(start, end)
        word = (hashes >> np.uint64(64 - _WORD_BITS)).astype(np.int64)

        def moved(values: np.ndarray, by: int, rest: int) -> np.ndarray:
            out = np.full(n, rest, np.int64)
            if by > 0:
                out[by:] = np.where(text[by:] == text[:-by], values[:-by], rest)
            elif n:
                out[:by] = np.where(text[:by] == text[-by:], values[-by:], rest)
            return out

        only, with_digit = shape == 1 << _DIGIT, (shape >> _DIGIT & 1) > 0
        self.features = [
            form,
            gap * _GAPS + after,
            moved(form, 1, _FORMS),
            moved(form, -1, _FORMS),
            moved(word, 1, 0),
            moved(word, -1, 0),
            moved(gap, 1, 0) * _SHAPES + shape,
            self._digit_chains(data, only, ~first),
        ]
        joined = ((gap | after) & 0b1011) > 0
        capital = _CLASSES[_UPPER][data[start]] if n else joined
        linked = np.where(with_digit, end - start >= 3, (end - start >= 4) & (joined | capital))
        part = np.zeros(n, np.uint64)
        at, numbers = np.flatnonzero(linked), with_digit[linked]
        part[at] = spans.of(
            np.where(numbers, np.maximum(start[at], end[at] - _LIKE[0]), start[at]),
            np.where(numbers, end[at], np.minimum(end[at], start[at] + _LIKE[1])),
        )
        self.edges = join_edges(
            chain_edges(text), skip_edges(text, hashes, linked, REPEAT), skip_edges(text, part, linked, SIMILAR)
        )

    def _digit_chains(self, data: np.ndarray, only: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """Digits of the numbers that a number stands among, and whether they pass the card checksum."""
        start, end = self.found.start, self.found.end
        out = np.zeros(len(start), np.int64)
        at = np.flatnonzero(only)
        if not len(at):
            return out
        digits = _sums(_CLASSES[_DIGIT][data])
        follows = np.zeros(len(at), dtype=bool)
        follows[1:] = (np.diff(at) == 1) & inner[at[1:]]
        between = end[at[:-1]], start[at[1:]]
        follows[1:] &= between[1] - between[0] <= _JOINT_LENGTH
        for step in range(_JOINT_LENGTH):
            # behind the gap stands a digit, which is no joint
            inside = between[0] + step < between[1]
            follows[1:] &= ~(inside & _JOINTS[data[np.minimum(between[0] + step, len(data) - 1)]])
        chain = np.cumsum(~follows) - 1
        heads = np.flatnonzero(~follows)
        tails = np.append(heads[1:], len(at)) - 1
        count = digits[end[at[tails]]] - digits[start[at[heads]]]
        # every digit by its place from the end of its chain
        place = np.flatnonzero(_CLASSES[_DIGIT][data])
        owner = np.searchsorted(start[at[heads]], place, "right") - 1
        mine = (owner >= 0) & (place < end[at[tails]][owner])
        place, owner = place[mine], owner[mine]
        value = data[place].astype(np.int64) - 0x30
        from_end = digits[end[at[tails]]][owner] - digits[place]
        value = np.where(from_end % 2 == 0, np.array(_DOUBLED)[value], value)
        passes = np.bincount(owner, value, minlength=len(heads)) % 10 == 0
        out[at] = (np.minimum(count, _CHAIN_DIGITS) * 2 + passes)[chain]
        return out


# ------------------------------------------------------------------ training


def _echo(text: str, span: Span, digits: str | None) -> str:
    """A second mention without the marks that the patterns need; with other digits it is of nothing known."""
    said = text[span.start : span.end]
    if digits:
        said = "".join(digits[int(c)] if c in _DIGITS else c for c in said)
    if BASE_KINDS[span.kind] == "card":
        return _NOT_DIGITS.sub("", said)[-4:]
    return " ".join(re.split(r"[^A-Za-z0-9]+", said.strip("+")))


def lesson(text: str, spans: list[Span], seed: int) -> tuple[str, list[tuple[int, int, int]]]:
    """A short text to learn from, and (start, end, label) of what is personal in it.

    It holds the surroundings of some spans of ``text``, other parts of it, for
    each of these spans a second mention without its marks, and a decoy that
    looks like that mention but repeats nothing.
    """
    rng = np.random.default_rng(seed)
    step = max(1, len(spans) // SPANS_PER_TEXT)
    parts: list[str] = []
    marks: list[tuple[int, int, int]] = []
    length = 0

    def add(part: str, inside: list[tuple[int, int, int]] = ()) -> None:
        nonlocal length
        marks.extend((length + a, length + b, label) for a, b, label in inside)
        parts.append(part)
        length += len(part)

    def filler() -> str:
        at = int(rng.integers(0, max(1, len(text) - AROUND)))
        return text[at : at + AROUND // 2]

    starts = [s.start for s in spans]
    windows = [(max(0, s.start - AROUND), s.end + AROUND) for s in spans[::step][:SPANS_PER_TEXT]]
    # what is not personal, from all over the text
    windows += [(at, at + 2 * AROUND) for at in range(AROUND, len(text), max(len(text) // OTHER_WINDOWS, 2 * AROUND))]
    for low, high in windows:
        near = bisect_left(starts, low - 2 * AROUND), bisect_left(starts, high)
        inside = [(max(s.start, low), min(s.end, high), s.kind + 1) for s in spans[slice(*near)] if s.end > low]
        add(text[low:high], [(a - low, b - low, k) for a, b, k in inside])
        add("\n")
    for s in spans[::step][:SPANS_PER_TEXT]:
        mention = _echo(text, s, None)
        add(f"{filler()} ")
        add(mention, [(0, len(mention), s.kind + 1)])
        add(f" {filler()}\n{filler()} {_echo(text, s, ''.join(map(str, rng.permutation(10))))} {filler()}\n")
    return "".join(parts), marks


def _tagged_lesson(text: str, marks: list[tuple[int, int, int]]) -> tuple[_Tokens, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    tokens = _Tokens(raw, np.array([0, len(raw)]))
    begins = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    labels = np.zeros(len(tokens.found.start), np.int64)
    for a, b, label in marks:
        covered = (tokens.found.start < begins[b]) & (tokens.found.end > begins[a])
        labels[covered & (labels == 0)] = label
    return tokens, labels


def fit_personal(
    docs: DataFrame, *, sample_likely: int = SAMPLE_LIKELY, sample_other: int = SAMPLE_OTHER, steps: int = 80
) -> SkipChain | None:
    """Train the tagger on what the patterns find in ``docs(text)``.

    Different texts are drawn by their hash, ``sample_likely`` of those that may
    match a pattern and ``sample_other`` of the rest, over all rows; copies
    count once.  Only lessons (short extracts) reach the driver.  None if there
    is nothing to learn from.
    """
    # a text counts once however many rows have it, and copies are combined in the map task
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "personal-texts")
    likely = F.col("text").contains("@") | F.col("text").rlike(_LIKELY)
    hashed = docs.where("text is not null").select(F.xxhash64("text").alias("h"), likely.alias("likely")).distinct()
    hashed = materialize(hashed, "personal-texts", path)
    drawn = [
        hashed.where(F.col("likely") == kind).orderBy(F.xxhash64("h"), "h").limit(n).select("h")
        for kind, n in ((True, sample_likely), (False, sample_other))
    ]
    chosen = drawn[0].unionByName(drawn[1])
    # bounded by sample_likely + sample_other
    rows = docs.select("text", F.xxhash64("text").alias("h")).join(F.broadcast(chosen), "h", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("h").to_pylist()
            lessons = [
                lesson(t, base_spans(t), h & 0xFFFFFFFF) for t, h in zip(batch.column("text").to_pylist(), hashes)
            ]
            flat = [[x for mark in marks for x in mark] for _, marks in lessons]
            columns = [pa.array(hashes, pa.int64()), pa.array([t for t, _ in lessons], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flat, pa.list_(pa.int32()))], ["h", "text", "marks"])

    lessons = rows.select("h", "text").mapInArrow(run, "h bigint, text string, marks array<int>")
    found = sorted(lessons.dropDuplicates(["h"]).collect())
    discard(spark, path)
    tagged = [_tagged_lesson(r["text"], list(zip(*[iter(r["marks"])] * 3))) for r in found]
    tagged = [(tokens, labels) for tokens, labels in tagged if len(labels)]
    if not tagged or not any(labels.any() for _, labels in tagged):
        return None
    offsets = np.cumsum([0, *[len(labels) for _, labels in tagged]])
    features = [np.concatenate(parts) for parts in zip(*[tokens.features for tokens, _ in tagged])]
    edges = join_edges(*[
        Edges(t.edges.one + at, t.edges.other + at, t.edges.kind) for (t, _), at in zip(tagged, offsets)
    ])
    labels = np.concatenate([labels for _, labels in tagged])
    return fit_skip_chain(features, _WIDTHS, labels, edges, 1 + len(BASE_KINDS), steps=steps)


# ------------------------------------------------------------------ search


def _tag(model: SkipChain, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, label, first byte, end byte) of every run of tokens with one label."""
    tokens = _Tokens(data, bounds)
    found = tokens.found
    if not len(found.start):
        return
    labels = decode(model, model.emissions(tokens.features), tokens.edges)
    marked = np.flatnonzero(labels)
    if not len(marked):
        return
    new = np.ones(len(marked), dtype=bool)
    new[1:] = (np.diff(marked) > 1) | (labels[marked[1:]] != labels[marked[:-1]])
    new[1:] |= (found.text[marked[1:]] != found.text[marked[:-1]]) | (tokens.gap[marked[1:]] > _JOINT_LENGTH)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(marked)) - 1
    for a, b in zip(marked[heads], marked[tails]):
        yield int(found.text[a]), int(labels[a]), int(found.start[a]), int(found.end[b])


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_personal(docs: DataFrame, model: SkipChain | None, *, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Personal data in every whole text of ``docs(text)``.

    Returns doc (a struct of the columns named in ``carry``) and spans: kind
    (email, ip, card or phone for the fixed patterns; tagged_email and so on
    for what the tagger adds outside of those), start and end in code points, by
    start, then kind as listed here.  Spans of different patterns may overlap.
    A null or empty text has none; a very long text is worked on whole, in time
    linear in it; rows that repeat have a row each; columns not carried are
    ignored; an empty table gives no rows.  Without a model only the patterns
    are looked for.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in carry if c != "text"]
    rows = docs.select("text", F.struct(F.lit(0).alias("_"), *rest).alias("rest"))
    kept = ["rest", "text"] if "text" in carry else ["rest"]
    schema = rows.select(*kept).schema.add(
        "spans", T.ArrayType(T.StructType.fromDDL("kind string, start bigint, end bigint"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for piece in pieces(batch.column("text")):
                raw, bounds = piece.data.tobytes(), piece.bounds
                digits = np.diff(_sums(_CLASSES[_DIGIT][piece.data])[bounds])
                base: list[list[Span]] = []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    # numbers have four digits or more
                    may = digits[i] >= 4 or raw.find(b"@", a, b) >= 0
                    base.append(base_spans(raw[a:b].decode()) if may else [])
                added: list[list[Span]] = [[] for _ in base]
                if shared.value is not None:
                    points = _sums((piece.data & 0xC0) != 0x80)
                    for i, label, low, high in _tag(shared.value, piece.data, bounds):
                        zero = points[bounds[i]]
                        kind = len(BASE_KINDS) + label - 1
                        added[i].append(Span(int(points[low] - zero), kind, int(points[high] - zero)))
                for own, more in zip(base, added):
                    own = sorted(own + apart(own, more))
                    spans.append([{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in own])
            columns = [*[batch.column(c) for c in kept], pa.array(spans, _SPAN_TYPE)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "spans"])

    doc = F.struct(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in carry])
    return rows.mapInArrow(run, schema).select(doc.alias("doc"), "spans")
