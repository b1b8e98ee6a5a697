"""Spelling variants against all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from clickweave.llm.variants import count_words, group_variants, near_pairs
from tests.llm.corpus import frame, rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(data, least=7, every=31):
    out = Counter()
    for doc_id, text in data:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                out[run] += 1
    return out


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts, least=2, factor=10):
    kept = {w: n for w, n in counts.items() if n >= least}
    near = {w: [v for v in kept if is_near(w, v)] for w in kept}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-kept[v], v), default=None)
        form[w] = best if best is not None and kept[best] >= factor * kept[w] else None
    out = set()
    for w in kept:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, kept[w], len(near[w]), form[w], kept.get(form[w]), root))
    return out


def vocabulary(seed=1, n=250):
    rng = random.Random(seed)
    counts = {}
    # few letters and common beginnings, so that chunks are crowded and one edit has several places
    stems = ["aaaa", "abababab", "prefixé", "x"]
    for _ in range(n):
        word = rng.choice(stems) + "".join(rng.choice("abé") for _ in range(rng.randint(1, 9)))
        counts[word] = rng.choice([1, 2, 3, 3, 30, 300, 3000])
    # a chain of forms, and ties
    counts |= {"chainword": 2, "chainworda": 20, "chainwordab": 200, "chainwordabc": 2000}
    counts |= {"tieword": 2, "tiewordb": 50, "tieworda": 50, "tieworé": 50}
    counts |= {"a" * 5000: 2, "a" * 5001: 40, "\U0001f600bcdefgh": 3, "bcdefgh": 90}
    return counts


@pytest.mark.parametrize("group_pairs", [0, 5, 512])
def test_groups(spark, group_pairs):
    counts = vocabulary()
    data = [*counts.items(), (None, 5)]
    df = spark.createDataFrame(data, "word string, n bigint").repartition(3)
    got = group_variants(df, group_pairs=group_pairs)
    found = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_groups(counts)
    assert ("chainword", 2, 1, "chainworda", 20, "chainwordabc") in found
    assert any(r[0] == "tieword" and r[3] == "tieworda" for r in found)


def test_pairs_come_once(spark):
    counts = vocabulary(2)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = [frozenset((r.a, r.b)) for r in near_pairs(df, group_pairs=3).collect()]
    words = sorted(counts)
    assert Counter(got) == Counter(frozenset((a, b)) for a in words for b in words if a < b and is_near(a, b))


@pytest.mark.parametrize("every", [None, 2, 31])
def test_counts(spark, every):
    texts = [
        "Wordlike WORDLIKE wordlike ÀÉÿéïöü ×÷abcdefg Āabcdefg",
        "naïvetés abcdefgh¿abcdefgh",
        "x" * 3000,
        "abcdefg1abcdefg_abcdefg",
        "中文abcdefg\U0001f600abcdefg",
    ]
    data = [*rows(), *[(70 + i, t) for i, t in enumerate(texts * 3)], (None, texts[0])]
    counted = count_words(frame(spark, data), typo_every=every)
    assert {r.word: r.n for r in counted.collect()} == dict(plain_counts(data, every=every))


def test_one_word_in_most_rows(spark):
    data = [(i, "commonword commonword " + ("commonwords" if i % 50 == 0 else "")) for i in range(2000)]
    found = group_variants(count_words(frame(spark, data))).collect()
    assert {(r.word, r.n, r.form, r.root) for r in found} == {
        ("commonword", 4000, None, "commonword"),
        ("commonwords", 40, "commonword", "commonword"),
    }


def test_nothing(spark):
    for data in ([], [(1, None), (2, ""), (None, "short words only")]):
        assert group_variants(count_words(frame(spark, data))).count() == 0
