"""Toxicity by weak supervision: lexicon and pattern voters, a label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.linear import fit_logistic, sigmoid
from clickweave.llm.text import LOWER, Piece, SpanHashes, byte_set, mix, pieces, words
from clickweave.plans.scratch import discard, materialize, scratch_path

# rows the model is learned from: at most so many of either label, those whose ids hash lowest
SAMPLE_ROWS_PER_LABEL = 6000
# terms the lexicons and the classifier know, at most
TERMS = 4096
# a term enters a lexicon if, drawing toxic and clean rows equally often, a row that has it is toxic at
# least this often; both shares are taken so many standard deviations to the worse
MIN_PRECISION = 0.92
CAUTION = 1.64
# lexicons of a kind of term; terms are dealt to them by content
LEXICONS_PER_KIND = 3
EM_ROUNDS = 50

# a term is a whole word or the first so many bytes of a longer one
_PREFIXES = (4, 5, 6, 7, 8)
_KINDS = 1 + len(_PREFIXES)
_KIND_SALTS = mix(np.arange(_KINDS, dtype=np.uint64))
_SEPARATORS = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_FILTER_BITS = 16

# fixed values: English words of abuse, a lexicon that needs no labels
ABUSE = (
    "bastard", "bitch", "clown", "crap", "creep", "cretin", "damn", "degenerate", "despicable", "dimwit",
    "disgusting", "dumb", "dunce", "filth", "fool", "freak", "garbage", "hate", "idiot", "imbecile",
    "jerk", "kill", "loser", "lunatic", "moron", "pathetic", "pig", "rat", "rubbish", "scum",
    "shit", "slime", "stupid", "trash", "ugly", "useless", "vermin", "vile", "worthless", "wretch",
)


def _kind(hashes: np.ndarray, kind: int) -> np.ndarray:
    return hashes ^ _KIND_SALTS[kind]


def _terms(data: np.ndarray, bounds: np.ndarray, known: np.ndarray | None = None) -> Iterator[tuple]:
    """(kind, texts, hashes, number of words per text) of every term, or of those in the filter ``known``."""
    data = LOWER[data]
    found = words(data, bounds, _SEPARATORS)
    spans = SpanHashes(data)
    length = found.end - found.start
    for kind in range(_KINDS):
        if kind == 0:
            start, end, text = found.start, found.end, found.text
        else:
            long = length > _PREFIXES[kind - 1]
            start, text = found.start[long], found.text[long]
            end = start + _PREFIXES[kind - 1]
        hashes = _kind(spans.of(start, end), kind)
        if known is not None:
            maybe = known[(hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)]
            hashes, text = hashes[maybe], text[maybe]
        yield kind, text, hashes


def _abuse_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(ABUSE).encode(), np.uint8)
    return np.sort(np.concatenate([h for k, _, h in _terms(data, np.array([0, len(data)])) if k == 0]))


class ToxicityModel(NamedTuple):
    """Sorted term hashes with weights; the bias; what the label model found of the voters."""

    terms: np.ndarray
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray
    correlations: np.ndarray

    def filter(self) -> np.ndarray:
        table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        table[(self.terms & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        return table

    def score(self, data: np.ndarray, bounds: np.ndarray, known: np.ndarray) -> np.ndarray:
        margin = np.full(len(bounds) - 1, self.bias)
        if not len(self.terms):
            return sigmoid(margin)
        pairs = []
        for _, text, hashes in _terms(data, bounds, known):
            place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
            hit = self.terms[place] == hashes
            pairs.append(text[hit] * len(self.terms) + place[hit])
        pairs = np.unique(np.concatenate(pairs))
        text, place = np.divmod(pairs, len(self.terms))
        return sigmoid(margin + np.bincount(text, weights=self.weights[place], minlength=len(margin)))


class Votes(NamedTuple):
    """+1 toxic, -1 clean, 0 no opinion: one row per text, one column per voter."""

    names: list[str]
    votes: np.ndarray


def _vote(
    rows: np.ndarray, terms: np.ndarray, distinct: np.ndarray, lexicons: dict[str, np.ndarray]
) -> Votes:
    """Votes of the lexicons, and of patterns in how often and how densely they speak up.

    ``rows`` and ``terms`` are the hits on the lexicons, ``distinct`` the number of terms of each row.
    """
    n = len(distinct)
    names, columns = [], []
    hits = {}
    for name, lexicon in lexicons.items():
        found = np.isin(terms, lexicon)
        hits[name] = np.bincount(rows[found], minlength=n)
        names.append(f"has {name}")
        columns.append((hits[name] > 0).astype(np.int8))
    total = np.sum(list(hits.values()), axis=0) if hits else np.zeros(n)
    kinds = np.sum([h > 0 for h in hits.values()], axis=0) if hits else np.zeros(n)
    for name, vote in {
        "two terms": total >= 2,
        "five terms": total >= 5,
        "two lexicons": kinds >= 2,
        "dense": total > 0.01 * np.maximum(distinct, 1),
    }.items():
        names.append(name)
        columns.append(vote.astype(np.int8))
    for name, silent in {"no term": total == 0, "no lexicon of words": kinds == 0}.items():
        names.append(name)
        columns.append(-silent.astype(np.int8))
    return Votes(names, np.array(columns).T.reshape(n, len(names)))


class LabelModel(NamedTuple):
    posterior: np.ndarray
    # of each voter, the chance that an opinion of its is right
    accuracies: np.ndarray
    correlations: np.ndarray


def fit_label_model(votes: np.ndarray, gold: np.ndarray, *, rounds: int = EM_ROUNDS) -> LabelModel:
    """Posterior toxicity of texts from votes, by expectation maximisation.

    Each voter speaks with a chance that depends on the hidden label.  Voters
    that err together are found from their residuals given the label; the
    opinion of a voter counts less the more others repeat it.  ``gold`` (the
    noisy labels) starts the posterior and takes part as one more voter.
    """
    n, m = votes.shape
    spoken = votes != 0
    posterior = np.clip(gold.astype(float), 0.1, 0.9)
    accuracy, correlation = np.full(m, 0.5), np.eye(m)
    for _ in range(rounds):
        prior = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        speaks = np.stack(
            [
                (spoken.T @ p + 0.5) / (p.sum() + 1.0)
                for p in (1 - posterior, posterior)
            ]
        )
        speaks = np.clip(speaks, 1e-3, 1 - 1e-3)
        residual = spoken - (posterior[:, None] * speaks[1] + (1 - posterior)[:, None] * speaks[0])
        deviation = np.sqrt((residual**2).mean(axis=0)) + 1e-6
        correlation = residual.T @ residual / n / np.outer(deviation, deviation)
        weight = 1.0 / np.maximum(1.0, np.clip(correlation, 0, 1).sum(axis=0))
        evidence = np.where(spoken, np.log(speaks[1] / speaks[0]), np.log((1 - speaks[1]) / (1 - speaks[0])))
        own = np.clip([(gold * (1 - posterior)).sum(), (gold * posterior).sum()], 0.5, None)
        own = np.clip(own / np.clip([(1 - posterior).sum(), posterior.sum()], 1, None), 0.02, 0.98)
        odds = np.log(prior / (1 - prior)) + evidence @ weight
        odds = odds + np.where(gold > 0, np.log(own[1] / own[0]), np.log((1 - own[1]) / (1 - own[0])))
        new = sigmoid(odds)
        right = np.where(votes > 0, new[:, None], np.where(votes < 0, 1 - new[:, None], 0)).sum(axis=0)
        accuracy = (right + 0.5) / (spoken.sum(axis=0) + 1.0)
        done = np.abs(new - posterior).max() < 1e-4
        posterior = new
        if done:
            break
    return LabelModel(posterior, accuracy, correlation)


def _signed(hashes: np.ndarray) -> np.ndarray:
    """Hashes as Spark's integers, in the same order."""
    return (hashes ^ np.uint64(1 << 63)).view(np.int64)


def _distinct_terms(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and kind of the distinct terms of each text, texts in order."""
    found = list(_terms(piece.data, piece.bounds))
    text = np.concatenate([t for _, t, _ in found])
    kind = np.repeat(np.arange(_KINDS, dtype=np.uint8), [len(t) for _, t, _ in found])
    terms = np.concatenate([h for _, _, h in found])
    order = np.lexsort((terms, text))
    text, terms, kind = text[order], terms[order], kind[order]
    first = np.ones(len(text), dtype=bool)
    first[1:] = (text[1:] != text[:-1]) | (terms[1:] != terms[:-1])
    return text[first], terms[first], kind[first]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every term of a piece of texts, its kind and the number of toxic and of clean rows that have it."""
    names = ["term", "kind", "toxic", "clean"]
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for piece in pieces(batch.column("text")):
            text, terms, kind = _distinct_terms(piece)
            values, first, number = np.unique(terms, return_index=True, return_inverse=True)
            rows = np.bincount(number, minlength=len(values))
            bad = np.bincount(number, weights=toxic[piece.first + text], minlength=len(values)).astype(np.int64)
            columns = [_signed(values), kind[first].astype(np.int32), bad, rows - bad]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _lexicons(rows: DataFrame, limit: int) -> dict[str, np.ndarray]:
    """Terms of ``rows(text, toxic)`` that speak for toxicity, in several lexicons of each kind, and the fixed one.

    Terms are counted where the rows are; those that enter a lexicon reach the driver.
    """
    sizes = dict(rows.groupBy("toxic").count().collect())
    counts = rows.select("text", "toxic").mapInArrow(_count_terms, "term bigint, kind int, toxic bigint, clean bigint")
    counts = counts.groupBy("term").agg(F.max("kind").alias("kind"), *[F.sum(c).alias(c) for c in ("toxic", "clean")])
    toxic, clean = F.col("toxic").cast("double"), F.col("clean").cast("double")
    # shares of either label, so that the number of rows of each does not matter
    a = F.greatest(toxic - CAUTION * F.sqrt(toxic), F.lit(0.0)) / max(1, sizes.get(1, 0))
    b = (clean + 1 + CAUTION * F.sqrt(clean + 1)) / (sizes.get(0, 0) + 1)
    strength = toxic * F.log(F.greatest(a, F.lit(1e-12)) / b)
    best = counts.where(a / (a + b) >= MIN_PRECISION).withColumn("strength", strength).where("strength > 0")
    best = best.orderBy(F.desc("strength"), "term").limit(limit).select("term", "kind").collect()
    values = np.array([r["term"] for r in best], dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    kinds = np.array([r["kind"] for r in best], dtype=np.int64)
    found = {"abuse": _abuse_hashes()}
    for k in range(_KINDS):
        own = values[kinds == k]
        for part in range(LEXICONS_PER_KIND):
            lexicon = own[(own >> np.uint64(40)) % np.uint64(LEXICONS_PER_KIND) == part]
            if len(lexicon):
                found[f"kind {k} part {part}"] = np.sort(lexicon)
    return found


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, rows_per_label: int = SAMPLE_ROWS_PER_LABEL, terms: int = TERMS
) -> ToxicityModel:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; null labels teach nothing.

    At most ``rows_per_label`` ids of each label are used, those that hash
    lowest.  An id with several labels is toxic if any of them says so; of an
    id with several texts the one that hashes lowest teaches.  Terms are counted
    in Spark; the lexicons, of at most ``terms`` terms that tell most, and each
    row's hits on them are all that reaches the driver.  Lexicons are drawn from
    the sample, voters vote on it, the label model weighs the votes, and the
    classifier is trained on its posterior.  Without rows every score is one
    half at most.
    """
    given = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic")
    )
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for label in (0, 1):
        part = given.where(F.col("toxic") == label).orderBy(*by_hash).limit(rows_per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one row of an id: bounded by twice rows_per_label, and combined before it moves
    lowest = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"))).alias("row")
    rows = rows.groupBy("doc_id", "toxic").agg(lowest).select("toxic", "row.text")
    path = scratch_path(docs.sparkSession, "toxicity-sample")
    rows = materialize(rows, "toxicity-sample", path)

    lexicons = _lexicons(rows, terms)
    known = np.unique(np.concatenate(list(lexicons.values())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, blobs = [], []
            for piece in pieces(batch.column("text")):
                text, terms, _ = _distinct_terms(piece)
                place = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                hit = known[place] == terms
                borders = np.arange(piece.last - piece.first + 1)
                sizes.append(np.diff(np.searchsorted(text, borders)))
                cuts = np.searchsorted(text[hit], borders)
                place = place[hit].astype(np.uint16)
                blobs += [place[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            if blobs:
                columns = [batch.column("toxic"), pa.array(np.concatenate(sizes)), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "n", "x"])

    found = rows.select("text", "toxic").mapInArrow(run, "toxic int, n bigint, x binary").collect()
    discard(docs.sparkSession, path)
    none = np.zeros(0)
    if not found:
        return ToxicityModel(none.astype(np.uint64), none, -1.0, none, none)
    found.sort(key=lambda r: (r["toxic"], bytes(r["x"]), r["n"]))
    columns = np.concatenate([np.frombuffer(r["x"], np.uint16) for r in found]).astype(np.int64)
    at = np.repeat(np.arange(len(found)), [len(r["x"]) // 2 for r in found])
    gold = np.array([r["toxic"] for r in found], dtype=float)
    votes = _vote(at, known[columns], np.array([r["n"] for r in found]), lexicons)
    labels_ = fit_label_model(votes.votes, gold)
    weights, bias = fit_logistic(at, columns, labels_.posterior, len(known))
    return ToxicityModel(known, weights, bias, labels_.accuracies, labels_.correlations)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Toxicity of every row of ``docs(text)``: doc (the columns of ``carry``) and score (0 to 1).

    Whole texts count, however long, and nothing but the text is an input, so
    rows that repeat have equal scores.  A null or empty text has the score of a
    text without any known term.  Columns not carried are ignored; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in carry if c != "text"]
    rows = docs.select("text", F.struct(F.lit(0).alias("_"), *rest).alias("rest"))
    kept = ["rest", "text"] if "text" in carry else ["rest"]
    schema = rows.select(*kept).schema.add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.filter()
        for batch in batches:
            scores = [shared.value.score(p.data, p.bounds, known) for p in pieces(batch.column("text"))]
            if scores:
                columns = [*[batch.column(c) for c in kept], pa.array(np.concatenate(scores))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "score"])

    doc = F.struct(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in carry])
    return rows.mapInArrow(run, schema).select(doc.alias("doc"), "score")
