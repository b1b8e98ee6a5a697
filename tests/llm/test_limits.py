"""Long texts, many rows of one id, many short texts: bounded time and memory, and still right."""

import hashlib
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickweave.llm import language
from clickweave.llm.exact import exact_dedup
from clickweave.llm.jaccard import jaccard_components
from clickweave.llm.language import fit_languages, predict_languages
from clickweave.llm.lines import line_dedup
from clickweave.llm.secrets import KINDS, find_secrets, fit_tagger
from clickweave.llm.substring import substring_dedup
from clickweave.llm.text import Span, apart, pieces
from clickweave.llm.toxicity import fit_toxicity, score_toxicity
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"


def test_pieces_are_bounded_by_rows():
    column = pa.array(["ab"] * 1000 + [None] * 500)
    cut = list(pieces(column, rows=64))
    assert [p.first for p in cut][1:] == [p.last for p in cut][:-1] and cut[-1].last == 1500
    assert max(p.last - p.first for p in cut) == 64


def test_apart_is_the_overlap_test():
    rng = np.random.default_rng(2)
    for _ in range(300):
        base = sorted(Span(a, 0, a + int(rng.integers(1, 9))) for a in rng.integers(0, 60, rng.integers(0, 8)).tolist())
        starts = np.cumsum(rng.integers(1, 9, 6)).tolist()
        added = [Span(a, 3, b) for a, b in zip(starts[0::2], starts[1::2])]
        plain = [s for s in added if all(s.end <= b.start or b.end <= s.start for b in base)]
        assert apart(base, added) == plain


# ------------------------------------------------------------------ secrets


@pytest.fixture(scope="module")
def tagger(spark):
    return fit_tagger(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_a_long_list_of_digests_takes_linear_time(spark, tagger):
    text = "é\n" + "\n".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(300_000))
    began = time.time()
    found = find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), tagger).first()
    assert time.time() - began < 60
    base = [s for s in found.spans if s.kind == "hex"]
    assert len(base) >= 299_000
    assert all(text[s.start : s.end].isalnum() for s in base[::1000])


def test_many_rows_of_one_text_teach_once(spark):
    """A third of all rows are one text; the model is that of the different texts."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").where("doc_id < 150")
    copies = docs.where("doc_id = 3").crossJoin(spark.range(100)).select(F.lit(3).alias("doc_id"), "text")
    one, other = fit_tagger(docs, sample_docs=40), fit_tagger(docs.unionByName(copies), sample_docs=40)
    assert all(np.array_equal(a, b) for a, b in zip(one.tables, other.tables))


def test_secrets_beyond_the_patterns(spark, tagger):
    """Keys that no pattern matches, in the surroundings that secrets have, of documents not learned from."""
    rng = np.random.default_rng(8)
    alphabet = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id > 9000 and text is not null")
    texts, keys = [], []
    for r in docs.select("text").limit(60).collect():
        key = "".join(rng.choice(alphabet, 28))
        at = r.text.find(" ", len(r.text) // 2) + 1
        # the name of the setting is one that no pattern knows
        texts.append(f'{r.text[:at]}\npassphrase = "{key}"\n{r.text[at:]}')
        keys.append(key)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc.doc_id: r.spans for r in find_secrets(table, tagger).collect()}
    hit = sum(any(texts[i][s.start : s.end].find(k) >= 0 for s in found[i]) for i, k in enumerate(keys))
    print("secrets beyond the patterns found:", hit, "of", len(keys))
    # what is tagged is never ordinary prose
    clean = find_secrets(docs.select("doc_id", "text"), tagger).select(F.explode("spans").alias("s"))
    assert clean.where(F.col("s.kind") == KINDS[3]).count() <= 5


# ------------------------------------------------------------------ many rows of one id


def test_lines_of_many_equal_rows(spark):
    text = "\n".join(f"line {i} of it" for i in range(200))
    rows = spark.createDataFrame([(7, text)], "doc_id long, text string")
    rows = rows.crossJoin(spark.range(2000)).drop("id").union(spark.createDataFrame([(3, text), (9, text + "\nx")], rows.schema))
    began = time.time()
    found = line_dedup(rows).groupBy("doc_id", "n_lines", "n_removed").count().collect()
    assert time.time() - began < 60
    got = {(r.doc_id, r.n_lines): (r.n_removed, r["count"]) for r in found}
    assert got[(3, 200)] == (0, 1) and got[(7, 200)][1] == 2000 and got[(7, 200)][0] > 150


def plain_chunks(text, rolling, divisor):
    """Borders by one rolling hash after another, on numbers of any size."""
    bits = (1 << 64) - 1

    def mixed(h):
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & bits
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & bits
        return h ^ (h >> 31)

    def digest(line):
        total = 0
        for place, byte in enumerate(line):
            value = mixed(((byte + 1) * 0x9E3779B97F4A7C15) & bits)
            total = (total + value * pow(0x9E3779B97F4A7C15, place, 1 << 64)) & bits
        return mixed((total + len(line)) & bits)

    if not text:
        return []
    lines = text.encode().split(b"\n")
    digests, out, held = [digest(line) for line in lines], [], []
    for i, line in enumerate(lines):
        held.append(line)
        roll = 0
        for back in range(rolling):
            roll = (roll * 0x9E6C63D0876A9A47 + (digests[i - back] if i >= back else 0)) & bits
        if mixed(roll) % divisor == 0 or i == len(lines) - 1:
            out.append((len(held), b"\n".join(held)))
            held = []
    return out


def test_lines_against_borders_of_our_own(spark):
    rng = np.random.default_rng(6)
    data = []
    for i in range(40):
        lines = [f"l{rng.integers(0, 25)}" if rng.random() < 0.8 else "" for _ in range(int(rng.integers(0, 30)))]
        data.append((i, "\n".join(lines)))
    seen, expected = set(), {}
    for doc_id, text in data:
        kept, removed, count = [], 0, 0
        for lines, part in plain_chunks(text, 2, 4):
            count += lines
            if lines > 1 and part.strip() and part in seen:
                removed += lines
                continue
            if lines > 1 and part.strip():
                seen.add(part)
            kept.append(part)
        expected[doc_id] = (count, removed, b"\n".join(kept).decode())
    found = line_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in found} == expected
    assert sum(r.n_removed for r in found) > 0


@pytest.mark.parametrize("keep, pick", [("largest", max), ("smallest", min)])
def test_exact_with_rows_that_repeat(spark, keep, pick):
    data = [(5, "same")] * 700 + [(None, "same")] * 500 + [(None, "")] * 300 + [(8, "same"), (2, "same")] * 3
    data += [(9, None)] * 4 + [(11, "own")] * 2 + [(None, "lone")] * 2 + [(12, "x")]
    found = exact_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(5), keep=keep)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect())
    assert got == brute.exact(data, pick)


def test_substrings_of_many_rows_without_an_id(spark):
    words = " ".join(f"w{i}" for i in range(40))
    data = [(None, words)] * 60 + [(1, f"a {words} b"), (2, words)]
    found = substring_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(4))
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in found.collect())
    assert got[(1, 42, 0)] == 1 and got[(2, 40, 40)] == 1 and got[(None, 40, 40)] == 60


# ------------------------------------------------------------------ language, toxicity


def plain_language(model, text):
    """One text by the definition: family by duels, then language by duels."""
    if not any(c.isalpha() for c in text or ""):
        return "und"
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    x = language.features(raw, np.array([0, len(raw)]))[0]

    def winner(machine):
        if len(machine.classes) == 1:
            return machine.classes[0]
        wins, closest = Counter(), {}
        for (i, j), w in zip(machine.pairs, machine.weights):
            margin = float(x @ w[:-1] + w[-1])
            for k, m in ((i, margin), (j, -margin)):
                wins[k] += m > 0
                closest[k] = min(closest.get(k, np.inf), m)
        return machine.classes[max(range(len(machine.classes)), key=lambda k: (wins[k], closest[k], k))]

    return winner(model.languages[winner(model.families)])


def test_languages_against_one_text_at_a_time(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = fit_languages(docs.where("doc_id % 2 = 0"))
    texts = [r.text for r in docs.where("doc_id % 2 = 1").limit(150).collect()] + [None, "", "12 ?!", "x", "中文字"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc.doc_id: r.lang_pred for r in predict_languages(table, model).collect()}
    assert found == {i: plain_language(model, t) for i, t in enumerate(texts)}


def test_many_short_texts_in_one_batch(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = fit_languages(docs, sample_rows=200)
    texts = spark.range(0, 10_000, 1, 1).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "").otherwise("the word").alias("text")
    )
    assert predict_languages(texts, model).where("lang_pred = 'und'").count() == 5000
    assert language._PIECE_ROWS * (8 << language._SLOT_BITS) <= 16 << 20


def test_a_column_of_junk_languages_is_bounded(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    junk = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("j"), "doc_id")).otherwise(F.col("lang")))
    model = fit_languages(junk, languages=5, sample_rows=100)
    known = {c for m in model.languages.values() for c in m.classes}
    assert len(known) == 5 and {r.lang for r in docs.select("lang").distinct().collect() if r.lang} <= known


def test_conflicting_labels_and_repeated_rows_teach_alike(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    # every toxic id is also called clean somewhere, and every row comes twice
    doubted = labels.unionByName(labels.where("toxic = 1").withColumn("toxic", F.lit(0)))
    one, other = fit_toxicity(docs, labels), fit_toxicity(docs.unionByName(docs), doubted.repartition(3))
    assert np.array_equal(one.known if hasattr(one, "known") else one[0], other[0])
    scores = [
        {r.doc.doc_id: round(r.score, 9) for r in score_toxicity(docs, m).collect()} for m in (one, other)
    ]
    assert scores[0] == scores[1]




# ------------------------------------------------------------------ Jaccard join


def test_many_near_copies(spark):
    """3000 texts of one class, one word apart from a common one: classes and links, with several tiles."""
    base = [f"w{i}" for i in range(60)]
    data = []
    for i in range(3000):
        words = list(base)
        words[30] = f"own{i}"
        data.append((i, " ".join(words)))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(8)
    # two such sets share 51 of 61 shingles
    for limits in ({}, {"tile_sets": 700}):
        found = jaccard_components(docs, **limits)
        got = found.groupBy("n_shingles", "component_id", "n_links").count().collect()
        assert [tuple(r) for r in got] == [(56, 0, 2999, 3000)]


def test_near_copies_among_rows_without_an_id(spark):
    base = " ".join(f"w{i}" for i in range(60))
    data = [(None, base)] * 900 + [(4, base + " x"), (9, base)] + [(7, f"{base} y")] * 300 + [(12, "other words here")]
    found = jaccard_components(spark.createDataFrame(data, "doc_id long, text string").repartition(6)).collect()
    got = Counter((r.doc_id, r.component_id, r.n_links) for r in found)
    assert got == Counter({(None, 4, 1201): 900, (4, 4, 1201): 1, (9, 4, 1201): 1, (7, 4, 1201): 300, (12, 12, 0): 1})
