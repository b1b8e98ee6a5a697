"""Personal data: the patterns against plain regular expressions, the tagger on mentions it has not seen."""

import hashlib
import random
import re
import time
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import personal
from clickweave.llm.personal import BASE_KINDS, base_spans, find_personal, fit_personal, lesson
from clickweave.llm.queries import op12_personal_data
from clickweave.llm.skipchain import CHAIN, REPEAT, Edges, SkipChain, decode, fit_skip_chain, join_edges, skip_edges
from tests.llm.corpus import frame, rows

SF_DIR = "/root/testdata/sf0.01"
# fixed values: the patterns as the contract has them
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def joined(spans):
    return ",".join(f"{BASE_KINDS[k]}:{a}:{b}" for a, k, b in spans)


ODD = [
    "a@b@c.d x..y@z-.q.r.s-@t.u a@b.c@d.e @no.local me@nodot é@ü.de %@1.2",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.1.002 1.2.3 9.9.9.9.9 01.2.3.4444",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111111 4111  1111 1111 1111 7 4111111111111112",
    "0000000000000000 5500-0000-0000-0004-1 1 2",
    "+1 (132) 555-1352 +12 +1 ((( +49.30.1234567- +1234567890123456 ++49 30 123456 +4930123456x",
    "é" * 30 + " und.34@mail7.example.com " + "中" * 10 + " +1 (132) 555-1352",
    "+1 97.51.17.173@4111111111111111.de",
]


def test_patterns_on_odd_texts():
    for text in ODD:
        assert base_spans(text) == plain(text), text


def test_patterns_on_random_texts():
    rng = random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choice("001234599  ..--++@@ab(é") for _ in range(rng.randint(0, 60)))
        assert base_spans(text) == plain(text), text


def test_patterns_on_all_given_texts(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    assert all(base_spans(t or "") == plain(t) for t in texts)


@pytest.mark.parametrize("unit", ["1", "a", "1.", "1-", "+1 ", "a.b@", "@", "(", "+("])
def test_time_is_linear_in_a_text(unit):
    began = time.time()
    base_spans(unit * (2_000_000 // len(unit)))
    assert time.time() - began < 20


@pytest.fixture(scope="module")
def model(spark):
    return fit_personal(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_rows(spark, model):
    data = [*rows(), *[(5000 + i, t) for i, t in enumerate(ODD)], (None, ODD[0]), (5000, ODD[0])]
    for tagger in (model, None):
        found = find_personal(frame(spark, data), tagger, carry=["doc_id", "text", "spans"])
        got = Counter()
        for r in found.collect():
            base = [s for s in r.spans if s.kind in BASE_KINDS]
            got[(r.doc.doc_id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in base))] += 1
            assert [s.start for s in r.spans] == sorted(s.start for s in r.spans)
            added = [s for s in r.spans if s.kind not in BASE_KINDS]
            assert tagger is not None or not added
            for s in added:
                assert 0 <= s.start < s.end <= len(r.doc.text)
                assert all(s.end <= b.start or b.end <= s.start for b in base)
        assert got == Counter((i, joined(plain(t))) for i, t in data)


def test_empty_table_and_nothing_to_learn(spark, model):
    empty = frame(spark, rows()).limit(0)
    assert find_personal(empty, model).count() == 0
    assert fit_personal(empty) is None
    assert fit_personal(frame(spark, [(1, "no data here"), (2, None), (3, "")])) is None


def test_query(spark):
    found = op12_personal_data(spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for r in found:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) - {""} <= set(r.spans.split(","))


def test_second_mentions_are_found_and_clean_texts_left_alone(spark, model):
    """Mentions without the marks that the patterns need, in documents of another table."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 7 = 3 and text is not null")
    texts = [r.text for r in docs.collect()]
    personal_texts = [t for t in texts if base_spans(t)]
    assert len(personal_texts) > 30
    cases = [lesson(t, base_spans(t), 10**6 + i) for i, t in enumerate(personal_texts)]
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = {r.doc.doc_id: r.spans for r in find_personal(table, model).collect()}
    asked = hit = 0
    for i, (text, marks) in enumerate(cases):
        covered = [(s.start, s.end) for s in base_spans(text)]
        for a, b, label in marks:
            if all(b <= c or d <= a for c, d in covered):
                asked += 1
                kind = f"tagged_{BASE_KINDS[label - 1]}"
                hit += any(s.kind == kind and s.start < b and a < s.end for s in found[i])
    assert asked > 50 and hit >= 0.6 * asked
    clean = spark.createDataFrame([(i, t) for i, t in enumerate(texts) if not base_spans(t)], "doc_id long, text string")
    tagged = find_personal(clean, model).where(F.size("spans") > 0).count()
    assert tagged <= 0.005 * len(texts)


# ------------------------------------------------------------------ the field


def all_labellings(unary, edges, links):
    n, k = unary.shape
    for labels in product(range(k), repeat=n):
        score = sum(unary[i, y] for i, y in enumerate(labels))
        score += sum(links[t, labels[a], labels[b]] for a, b, t in zip(*edges))
        yield score, labels


def test_decoding_is_best_without_loops():
    rng = np.random.default_rng(0)
    for trial in range(40):
        # a chain of four, and a distant pair that closes no loop
        edges = Edges(np.array([0, 1, 3, 2]), np.array([1, 2, 4, 4]), np.array([CHAIN, CHAIN, CHAIN, REPEAT]))
        links = rng.normal(0, 1.5, (3, 3, 3))
        links[1:] = links[1:] + links[1:].transpose(0, 2, 1)
        unary = rng.normal(0, 2, (5, 3)) + [2 * (trial % 3), 0, 0]
        best = max(all_labellings(unary, edges, links))[1]
        assert tuple(decode(SkipChain([unary], links), unary, edges)) == best


def test_skip_edges_are_as_many_as_tokens():
    text, keys = np.array([0] * 8 + [1] * 4), np.array([1, 2, 1, 3, 1, 1, 2, 1, 1, 9, 1, 9], np.uint64)
    edges = skip_edges(text, keys, np.ones(12, bool), REPEAT)
    # neighbours (4, 5) are left to the chain
    assert sorted(zip(edges.one.tolist(), edges.other.tolist())) == [(0, 2), (1, 6), (2, 4), (5, 7), (8, 10), (9, 11)]


def test_fit_learns_that_repeats_agree():
    """Only the far mention shows what a token is; the near one looks like any other."""
    rng = np.random.default_rng(1)
    seen, labels, one, other = [], [], [], []
    for i in range(300):
        label = int(rng.integers(0, 2))
        seen += [label, 2]
        labels += [label, label]
        one.append(2 * i)
        other.append(2 * i + 1)
    edges = Edges(np.array(one), np.array(other), np.full(300, REPEAT))
    model = fit_skip_chain([np.array(seen)], [3], np.array(labels), edges, 2)
    got = decode(model, model.emissions([np.array([1, 2, 0, 2, 2])]), Edges(np.array([0, 2]), np.array([1, 3]), np.full(2, REPEAT)))
    assert got.tolist()[:4] == [1, 1, 0, 0]
    assert join_edges(edges, edges).one.shape == (600,)


def test_tokens_of_nothing():
    tokens = personal._Tokens(np.zeros(0, np.uint8), np.array([0, 0]))
    assert len(tokens.found.start) == 0 and all(len(f) == 0 for f in tokens.features)
