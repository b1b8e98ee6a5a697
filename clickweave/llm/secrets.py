"""Secret scan: fixed patterns, and a conditional random field that tags further tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.crf import Crf, fit_crf, viterbi
from clickweave.llm.text import LOWER, Span, Words, apart, byte_set, pieces, word_hashes, words
from clickweave.plans.scratch import discard, materialize, scratch_path

# different texts the tagger is trained on, half of them such that may hold a secret, those that hash
# lowest; of each, the surroundings of some secrets, evenly spread over it, and one more stretch
SAMPLE_DOCS = 4000
SECRETS_PER_TEXT = 8
STRETCH = 24
STEPS = 150

KINDS = ("assign", "access", "hex", "tagged")
BEGIN, INSIDE, OUTSIDE = 0, 1, 2

# fixed values: the patterns and least lengths of secrets
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_ASSIGN_LENGTH, _ACCESS_LENGTH, _HEX_LENGTH = 12, 18, 16

# texts that may match
_LIKELY = r"(?i)(?:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{16}"

_NOT_HEX = ~byte_set((0x30, 0x39), (0x61, 0x66))
# tokens are runs of the characters of keys, and of all that is not ASCII
_SEPARATORS = ~byte_set(
    (0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x2B, 0x2B), (0x2D, 0x2F), (0x3D, 0x3D), (0x5F, 0x5F), (0x80, 0xFF)
)
_CLASSES = {
    "digit": byte_set((0x30, 0x39)),
    "upper": byte_set((0x41, 0x5A)),
    "lower": byte_set((0x61, 0x7A)),
    "sign": byte_set((0x2B, 0x2B), (0x2D, 0x2F), (0x3D, 0x3D), (0x5F, 0x5F)),
    "other": byte_set((0x80, 0xFF)),
}
_LENGTHS = np.array([2, 4, 8, 12, 16, 20, 24, 32, 40, 48, 64, 128])
_CHANGES = np.array([1, 2, 3, 5, 8, 13])
_WORD_BITS = 12
_BINDING = byte_set((0x3A, 0x3A), (0x3D, 0x3D))
_QUOTE = byte_set((0x22, 0x22), (0x27, 0x27))
_CODE = byte_set((0x3A, 0x3B), (0x3D, 0x3D), (0x7B, 0x7D), (0x28, 0x29), (0x22, 0x22))

# values of each feature: shape, hexadecimal by length, changes of class by length, binding and quotes before,
# quote after, the two words before, the word after, file features
_WIDTHS = [
    32 * (len(_LENGTHS) + 1),
    2 * (len(_LENGTHS) + 1),
    (len(_CHANGES) + 1) * (len(_LENGTHS) + 1),
    8,
    2,
    1 << _WORD_BITS,
    1 << _WORD_BITS,
    1 << _WORD_BITS,
    64,
]


def _sums(marks: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(marks)))


def token_features(data: np.ndarray, bounds: np.ndarray, found: Words) -> list[np.ndarray]:
    """One value per token and feature, in the order of the width table."""
    start, end, text = found.start, found.end, found.text
    n = len(start)
    length = np.searchsorted(_LENGTHS, end - start, "right")
    counts = {name: _sums(table[data]) for name, table in _CLASSES.items()}
    has = [counts[name][end] > counts[name][start] for name in _CLASSES]
    shape = sum(h.astype(np.int64) << i for i, h in enumerate(has))
    hexes = _sums(~_NOT_HEX[data])
    is_hex = (hexes[end] - hexes[start]) == (end - start)
    kind = np.zeros(len(data), dtype=np.int8)
    for i, table in enumerate(_CLASSES.values()):
        kind[table[data]] = i + 1
    moves = _sums(kind[1:] != kind[:-1]) if len(data) else np.zeros(1, dtype=np.int64)
    changes = np.searchsorted(_CHANGES, moves[np.maximum(end - 1, start)] - moves[start], "right")
    # what stands between a token and its neighbours in the text
    before = np.where(np.arange(n) > found.first[text], np.concatenate(([0], end[:-1])), bounds[text])
    after = np.where(np.arange(n) + 1 < found.first[text + 1], np.concatenate((start[1:], [0])), bounds[text + 1])
    binding, quotes = _sums(_BINDING[data]), _sums(_QUOTE[data])
    binds = (binding[start] > binding[before]).astype(np.int64)
    # a sign of assignment may be a token of its own
    sign = np.zeros(n, dtype=np.int64)
    sign[1:] = (binding[end[:-1]] > binding[start[:-1]]) & (end[:-1] - start[:-1] <= 2) & (text[1:] == text[:-1])
    quoted = (quotes[start] > quotes[before]).astype(np.int64)
    closed = (quotes[after] > quotes[end]).astype(np.int64)
    word = (word_hashes(LOWER[data], start, end) >> np.uint64(64 - _WORD_BITS)).astype(np.int64)
    previous, earlier, following = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    previous[1:] = np.where(text[1:] == text[:-1], word[:-1], 0)
    earlier[2:] = np.where(text[2:] == text[:-2], word[:-2], 0)
    following[:-1] = np.where(text[1:] == text[:-1], word[1:], 0)
    size = np.maximum(np.diff(bounds), 1)
    code = np.diff(_sums(_CODE[data])[bounds]) / size
    digits = np.diff(counts["digit"][bounds]) / size
    file = (
        np.clip(np.log2(size) / 4, 0, 3).astype(np.int64) * 16
        + np.clip(code * 100, 0, 3).astype(np.int64) * 4
        + np.clip(digits * 50, 0, 3).astype(np.int64)
    )
    lengths = len(_LENGTHS) + 1
    return [
        shape * lengths + length,
        is_hex * lengths + length,
        changes * lengths + length,
        binds + 2 * sign + 4 * quoted,
        closed,
        previous,
        earlier,
        following,
        file[text],
    ]


def _hex_runs(data: np.ndarray, bounds: np.ndarray) -> Words:
    runs = words(data, bounds, _NOT_HEX)
    long = runs.end - runs.start >= _HEX_LENGTH
    text = runs.text[long]
    return Words(runs.start[long], runs.end[long], text, np.searchsorted(text, np.arange(len(bounds))))


def _pattern_spans(text: str) -> list[tuple[Span, int]]:
    """Matches of assign and access in code points, and where the secret in each begins."""
    found = []
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= _ASSIGN_LENGTH:
            found.append((Span(m.start(), 0, m.end()), m.start(2)))
    for m in _ACCESS.finditer(text):
        if len(m[0]) >= _ACCESS_LENGTH:
            found.append((Span(m.start(), 1, m.end()), m.start()))
    return found


class _Scan:
    """Base spans of a piece, and where the secrets in them are, per text; time is linear in the piece."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = data, bounds
        begins = (data & 0xC0) != 0x80
        # code points before every byte, and the first byte of every code point
        self.points = _sums(begins)
        first_bytes = np.append(np.flatnonzero(begins), len(data))
        binding = np.diff(_sums(_BINDING[data])[bounds])
        # spans of secrets alone, for the tagger: start, end in bytes
        self.secrets: dict[int, list[tuple[int, int]]] = {}
        # spans in code points of each text
        self.spans: dict[int, list[Span]] = {}
        raw = data.tobytes()
        for i in np.flatnonzero(bounds[1:] > bounds[:-1]):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if not binding[i] and raw.find(b"AKIA", a, b) < 0:
                continue
            zero = self.points[a]
            for span, secret in _pattern_spans(raw[a:b].decode()):
                self.spans.setdefault(int(i), []).append(span)
                self.secrets.setdefault(int(i), []).append(
                    (int(first_bytes[zero + secret]), int(first_bytes[zero + span.end]))
                )
        runs = _hex_runs(data, bounds)
        zero = self.points[bounds[runs.text]]
        starts, ends = self.points[runs.start] - zero, self.points[runs.end] - zero
        for i, low, high, start, end in zip(*[x.tolist() for x in (runs.text, runs.start, runs.end, starts, ends)]):
            self.spans.setdefault(i, []).append(Span(start, 2, end))
            self.secrets.setdefault(i, []).append((low, high))

    def point(self, i: int, byte: int) -> int:
        """Code points of text ``i`` before a byte."""
        return int(self.points[byte] - self.points[self.bounds[i]])

    def labels(self, found: Words) -> np.ndarray:
        """Tags that the base spans give to tokens."""
        labels = np.full(len(found.start), OUTSIDE)
        for i, secrets in self.secrets.items():
            low, high = int(found.first[i]), int(found.first[i + 1])
            starts, ends = found.start[low:high], found.end[low:high]
            secrets = sorted(secrets, key=lambda s: (s[0], -s[1]))
            # tokens neither overlap nor nest, so those of a secret are neighbours
            heads = low + np.searchsorted(ends, [a for a, _ in secrets], "right")
            tails = low + np.searchsorted(starts, [b for _, b in secrets], "left")
            for a, b in zip(heads.tolist(), tails.tolist()):
                fresh = a + np.flatnonzero(labels[a:b] == OUTSIDE)
                labels[fresh] = INSIDE
                if len(fresh) and (fresh[0] == low or labels[fresh[0] - 1] == OUTSIDE):
                    labels[fresh[0]] = BEGIN
        return labels


def fit_tagger(
    docs: DataFrame, *, sample_docs: int = SAMPLE_DOCS, stretch: int = STRETCH, steps: int = STEPS
) -> Crf | None:
    """Train the tagger on what the patterns find in ``docs(text)``.

    Different texts are drawn by their hash over all rows, half of
    ``sample_docs`` from those that may hold a secret, half from the others;
    copies count once.  Token features of the stretches around some of their
    secrets, and of one stretch of every text, reach the driver.  None if there
    is nothing to learn from.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "secret-texts")
    # a text counts once however many rows have it, and copies are combined in the map task
    hashed = docs.where("text is not null").select(
        F.xxhash64("text").alias("h"), F.col("text").rlike(_LIKELY).alias("likely")
    ).distinct()
    hashed = materialize(hashed, "secret-texts", path)
    drawn = [
        hashed.where(F.col("likely") == kind).orderBy(F.xxhash64("h"), "h").limit(sample_docs // 2).select("h")
        for kind in (True, False)
    ]
    # bounded by sample_docs
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))
    rows = docs.select("text", F.xxhash64("text").alias("h")).join(chosen, "h", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, blobs = [], []
            hashes = batch.column("h").to_pylist()
            for piece in pieces(batch.column("text")):
                found = words(piece.data, piece.bounds, _SEPARATORS)
                labels = _Scan(piece.data, piece.bounds).labels(found)
                table = np.stack([*token_features(piece.data, piece.bounds, found), labels]).astype(np.int16)
                for i, (low, high) in enumerate(zip(found.first[:-1], found.first[1:])):
                    if low == high:
                        continue
                    middle = low + (high - low) // 2
                    begins = low + np.flatnonzero(labels[low:high] == BEGIN)
                    some = begins[:: max(1, len(begins) // SECRETS_PER_TEXT)][:SECRETS_PER_TEXT]
                    for at in [middle, *some]:
                        a, b = max(low, at - stretch // 2), min(high, at + stretch // 2)
                        keys.append(hashes[piece.first + i])
                        blobs.append(table[:, a:b].T.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["h", "x"])

    # rows that repeat a text have the same stretches
    stretches = rows.select("h", "text").mapInArrow(run, "h bigint, x binary").distinct()
    found = sorted(bytes(r["x"]) for r in stretches.collect())
    discard(spark, path)
    if not found:
        return None
    columns = len(_WIDTHS) + 1
    table = np.frombuffer(b"".join(found), np.int16).reshape(-1, columns).astype(np.int64)
    first = np.concatenate(([0], np.cumsum([len(x) // (2 * columns) for x in found])))
    features = [table[:, i] for i in range(len(_WIDTHS))]
    return fit_crf(features, _WIDTHS, table[:, -1], first, 3, steps=steps)


def _tagged(model: Crf, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, first byte, end byte) of every run that the tagger marks."""
    found = words(data, bounds, _SEPARATORS)
    labels = viterbi(model, model.emissions(token_features(data, bounds, found)), found.first, OUTSIDE)
    marked = np.flatnonzero(labels != OUTSIDE)
    if not len(marked):
        return
    new = np.ones(len(marked), dtype=bool)
    new[1:] = (labels[marked[1:]] == BEGIN) | (np.diff(marked) > 1)
    new[1:] |= found.text[marked[1:]] != found.text[marked[:-1]]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(marked)) - 1
    for a, b in zip(marked[heads], marked[tails]):
        yield int(found.text[a]), int(found.start[a]), int(found.end[b])


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, model: Crf | None, *, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Secrets in every whole text of ``docs(text)``.

    Returns doc (a struct of the columns named in ``carry``) and spans: kind
    (assign, access or hex for the fixed patterns, tagged for what the tagger
    adds outside of those), start and end in code points, by start, then kind.
    A null or empty text has none; a very long text is worked on whole, in time
    linear in it; rows that repeat have a row each; ties of start keep the order
    of kinds; columns not carried are ignored; an empty table gives no rows.
    Without a model only the patterns are looked for.
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
                scan = _Scan(piece.data, piece.bounds)
                added: dict[int, list[Span]] = {}
                if shared.value is not None:
                    for i, low, high in _tagged(shared.value, piece.data, piece.bounds):
                        added.setdefault(i, []).append(Span(scan.point(i, low), 3, scan.point(i, high)))
                for i in range(piece.last - piece.first):
                    base = sorted(scan.spans.get(i, []))
                    own = sorted(base + apart(base, added.get(i, [])))
                    spans.append([{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in own])
            columns = [*[batch.column(c) for c in kept], pa.array(spans, _SPAN_TYPE)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "spans"])

    doc = F.struct(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in carry])
    return rows.mapInArrow(run, schema).select(doc.alias("doc"), "spans")
