"""Language identification: family first, then one-versus-one support vector machines inside it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.linear import fit_svm, sigmoid
from clickweave.llm.text import pieces

UNDETERMINED = "und"
# rows a model is fitted on: at most so many in all, and so many of a language
SAMPLE_ROWS = 8000
SAMPLE_ROWS_PER_LANGUAGE = 1000
# languages that are learned, the most frequent ones: the number of duels grows with its square
LANGUAGES = 64

# classes of hashes; how many times the wanted rows of a language are looked at
_DRAWS = 1 << 31
_SURPLUS = 4

_SLOT_BITS = 12
_GRAMS = (1, 2, 3)
_PIECE_BYTES = 1 << 19
# a text takes a vector of 32 KB, however short it is
_PIECE_ROWS = 256
_MARGIN_SCALE = 4.0

# fixed values: language families by ISO 639-1 code; a language not listed is a family of its own
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "lb", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "pa", "ur"),
}
_FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members}

# ASCII letters count, in lower case; bytes of other characters count as they are; all else separates
_NORMAL = np.full(256, 32, dtype=np.uint8)
_NORMAL[97:123] = np.arange(97, 123)
_NORMAL[128:] = np.arange(128, 256)


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One unit vector per text: square roots of the counts of hashed byte n-grams."""
    data = _NORMAL[data].astype(np.uint32)
    # runs of separators count once
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    ends = np.concatenate(([0], np.cumsum(keep)))[bounds]
    data = data[keep]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(ends))
    counts = np.zeros((len(bounds) - 1) << _SLOT_BITS)
    for n in _GRAMS:
        size = len(data) - n + 1
        if size <= 0:
            continue
        gram = np.full(size, n, dtype=np.uint32)
        for k in range(n):
            gram = gram * np.uint32(257) + data[k : k + size]
        slot = (gram * np.uint32(2654435761)) >> np.uint32(32 - _SLOT_BITS)
        inside = text[:size] == text[n - 1 :]
        inside &= (data[:size] != 32) | (n > 1)
        places = (text[:size][inside] << _SLOT_BITS) + slot[inside]
        counts += np.bincount(places, minlength=len(counts))
    x = np.sqrt(counts).reshape(-1, 1 << _SLOT_BITS)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def _has_letter(texts: pa.Array) -> np.ndarray:
    """Whether a text has any letter of any script."""
    ascii_letter = pc.match_substring_regex(texts, "[A-Za-z]").to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(~ascii_letter):
        ascii_letter[i] = any(c.isalpha() for c in texts[i].as_py())
    return ascii_letter


class Machine(NamedTuple):
    """Pairwise separators of some classes: classes[i] against classes[j] for each pair, weights with bias."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class number and confidence (that of its closest duel) of each row."""
        if len(self.classes) == 1:
            return np.zeros(len(x), dtype=np.int64), np.ones(len(x))
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        duel = np.full((len(x), len(self.classes), len(self.classes)), np.inf)
        for k, (i, j) in enumerate(self.pairs):
            duel[:, i, j] = margins[:, k]
            duel[:, j, i] = -margins[:, k]
        wins = (duel > 0).sum(axis=2)
        closest = duel.min(axis=2)
        # most duels won; among equals the one whose closest duel is clearest
        best = np.lexsort((closest, wins), axis=1)[:, -1]
        return best, sigmoid(_MARGIN_SCALE * closest[np.arange(len(x)), best])


def _fit_machine(x: np.ndarray, names: np.ndarray) -> Machine:
    classes = sorted(set(names.tolist()))
    pairs, weights = list(combinations(range(len(classes)), 2)), []
    for i, j in pairs:
        own = (names == classes[i]) | (names == classes[j])
        # all rows need no copy
        weights.append(fit_svm(x if own.all() else x[own], np.where(names[own] == classes[i], 1.0, -1.0)))
    return Machine(classes, pairs, np.array(weights))


class LanguageModel(NamedTuple):
    families: Machine | None
    languages: dict[str, Machine]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        languages, scores = np.full(len(x), UNDETERMINED, dtype=object), np.zeros(len(x))
        if self.families is None:
            return languages, scores
        family, sure = self.families.decide(x)
        for f, name in enumerate(self.families.classes):
            own = np.flatnonzero(family == f)
            if len(own):
                machine = self.languages[name]
                best, inner = machine.decide(x[own])
                languages[own] = np.array(machine.classes, dtype=object)[best]
                scores[own] = sure[own] * inner
        return languages, scores


def fit_languages(
    labelled: DataFrame,
    *,
    sample_rows: int = SAMPLE_ROWS,
    rows_per_language: int = SAMPLE_ROWS_PER_LANGUAGE,
    languages: int = LANGUAGES,
) -> LanguageModel:
    """Learn from ``labelled(doc_id, text, lang)``; rows without a language or text teach nothing.

    The model is fitted on at most ``sample_rows`` rows and ``rows_per_language``
    of each language, those that hash lowest by id and text: rows without an id
    take part like others, and equal rows count once.  Of more than ``languages``
    languages those with most different rows are learned (ties: by name), and
    texts in the others are taken for one of these.  Only vectors of fixed
    length (8 KB each) reach the driver.  Without rows nothing is ever recognised.
    """
    key = F.xxhash64("doc_id", "text").alias("_key")
    usable = labelled.where("lang is not null and text is not null").select("text", "lang", key)
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("_key").alias("_n"))
    counts = counts.orderBy(F.desc("_n"), "lang").limit(min(languages, sample_rows))
    share = min(rows_per_language, sample_rows // max(1, counts.count()))
    # of each language a few times as many texts as are wanted, by their hash; then exactly those
    draw = F.pmod("_key", F.lit(_DRAWS))
    likely = usable.select("lang", "_key").join(F.broadcast(counts), "lang")
    likely = likely.where(draw * F.col("_n") < F.lit(float(_DRAWS)) * (_SURPLUS * share)).select("lang", "_key").distinct()
    lowest = Window.partitionBy("lang").orderBy(draw, "_key")
    chosen = likely.withColumn("_nth", F.row_number().over(lowest)).where(F.col("_nth") <= share)
    rows = usable.join(F.broadcast(chosen.select("lang", "_key")), ["lang", "_key"], "left_semi")
    # repeated rows teach once: bounded by sample_rows
    rows = rows.groupBy("lang", "_key").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.utf8_lower(batch.column("text"))
            vectors = [
                v.astype(np.float16).tobytes()
                for piece in pieces(texts, _PIECE_BYTES, _PIECE_ROWS)
                for v in features(piece.data, piece.bounds)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(vectors, pa.binary())], ["lang", "x"])

    found = rows.select("text", "lang").mapInArrow(run, "lang string, x binary").collect()
    if not found:
        return LanguageModel(None, {})
    found.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    names = np.array([r["lang"] for r in found], dtype=object)
    x = np.empty((len(found), 1 << _SLOT_BITS), np.float32)
    for i in range(len(found)):
        x[i] = np.frombuffer(found[i]["x"], np.float16)
        found[i] = None
    families = np.array([family_of(v) for v in names], dtype=object)
    inner = {f: _fit_machine(x[families == f], names[families == f]) for f in sorted(set(families.tolist()))}
    return LanguageModel(_fit_machine(x, families), inner)


def predict_languages(docs: DataFrame, model: LanguageModel, *, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Language of every row of ``docs(text)``.

    Returns doc (a struct of the columns named in ``carry``), lang_pred and
    score (0 to 1).  A null text, or one without any letter, is ``und`` with
    score 0.  Whole texts count, however long; nothing but the text is an input,
    so rows that repeat have equal answers; of languages that win equally many
    duels the one with the clearest duel is taken, then the last by name.
    Columns not carried are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in carry if c != "text"]
    rows = docs.select("text", F.struct(F.lit(0).alias("_"), *rest).alias("rest"))
    kept = ["rest", "text"] if "text" in carry else ["rest"]
    schema = rows.select(*kept).schema.add("lang_pred", T.StringType()).add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").fill_null("")
            languages, scores = [], []
            for piece in pieces(pc.utf8_lower(column), _PIECE_BYTES, _PIECE_ROWS):
                names, sure = shared.value.predict(features(piece.data, piece.bounds))
                languages.append(names)
                scores.append(sure)
            if not languages:
                continue
            names, sure = np.concatenate(languages), np.concatenate(scores)
            empty = ~_has_letter(column)
            names[empty], sure[empty] = UNDETERMINED, 0.0
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(names.tolist(), pa.string()), pa.array(sure)],
                [*kept, "lang_pred", "score"],
            )

    doc = F.struct(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in carry])
    return rows.mapInArrow(run, schema).select(doc.alias("doc"), "lang_pred", "score")
