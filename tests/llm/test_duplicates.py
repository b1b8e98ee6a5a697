"""Exact, near, substring and line duplicates against plain versions."""

from collections import Counter

import numpy as np
import pytest

from clickweave.llm.exact import exact_dedup
from clickweave.llm.jaccard import jaccard_components
from clickweave.llm.lines import chunks, line_dedup
from clickweave.llm.spread import components, spread_lookup
from clickweave.llm.substring import substring_dedup
from tests.llm import brute
from tests.llm.corpus import SCHEMA, frame, rows

DATA = rows()


def counted(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("keep, pick", [("largest", max), ("smallest", min)])
def test_exact(spark, keep, pick):
    got = counted(exact_dedup(frame(spark, DATA), keep=keep), "doc_id", "keep_id", "group_size", "kept")
    assert got == brute.exact(DATA, pick)


@pytest.mark.parametrize("runs, fan_in", [(1, 2), (5, 2), (64, 4)])
def test_exact_tree_shapes(spark, runs, fan_in):
    found = exact_dedup(frame(spark, DATA), runs=runs, fan_in=fan_in)
    assert counted(found, "doc_id", "keep_id", "group_size", "kept") == brute.exact(DATA)


def test_exact_is_native_and_carries(spark):
    found = exact_dedup(frame(spark, DATA), carry=["doc_id", "text", "unit"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    assert found.where("kept").select("doc.*").count() == len({t or "" for _, t in DATA})


def test_jaccard(spark):
    got = counted(jaccard_components(frame(spark, DATA)), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == Counter(brute.jaccard(DATA, 5, 80))


def test_jaccard_same_over_shuffles_and_tiles(spark):
    found = jaccard_components(frame(spark, DATA), broadcast_rows=-1, tile_shingles=300)
    got = counted(found, "doc_id", "n_shingles", "component_id", "n_links")
    assert got == Counter(brute.jaccard(DATA, 5, 80))


@pytest.mark.parametrize("k, percent", [(1, 50), (3, 60)])
def test_jaccard_other_parameters(spark, k, percent):
    data = rows(seed=11, n=50)
    found = jaccard_components(frame(spark, data), shingle_words=k, percent=percent)
    got = counted(found, "doc_id", "n_shingles", "component_id", "n_links")
    assert got == Counter(brute.jaccard(data, k, percent))


def test_jaccard_chain_of_near_copies(spark):
    """Neighbours link, ends do not: one class, and one large group of copies beside it."""
    base = [f"c{i}" for i in range(120)]
    chain = []
    for i in range(40):
        base[3 * i : 3 * i + 2] = [f"new{i}a", f"new{i}b"]
        chain.append((i, " ".join(base)))
    data = chain + [(1000 + i, "the same text in many places " * 3) for i in range(200)]
    got = counted(jaccard_components(frame(spark, data)), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == Counter(brute.jaccard(data, 5, 80))


def test_substring(spark):
    found = substring_dedup(frame(spark, DATA))
    assert counted(found, "doc_id", "n_words", "n_removed", "kept_text") == Counter(brute.substring(DATA, 20))


def test_substring_small_window_and_repeats(spark):
    data = [(i, t) for i, (_, t) in enumerate(rows(seed=3, n=30))] + [(7, "a b c d e f g h a b c d e f g h")]
    found = substring_dedup(frame(spark, data), window=6, anchor=3)
    assert counted(found, "doc_id", "n_words", "n_removed", "kept_text") == Counter(brute.substring(data, 6))


def test_substring_factors_point_at_equal_words(spark):
    data = [(i, t) for i, (_, t) in enumerate(rows(seed=9, n=40))]
    texts = {i: brute.space_words(t) for i, t in data}
    factors = [(r.doc_id, f) for r in substring_dedup(frame(spark, data)).collect() for f in r.factors]
    assert factors
    for doc_id, f in factors:
        length = f.end - f.start
        assert length >= 20
        assert (f.source_id, f.source_start) < (doc_id, f.start)
        source = texts[f.source_id][f.source_start : f.source_start + length]
        assert source == texts[doc_id][f.start : f.end]


def plain_lines(data):
    seen, out = set(), {}
    for doc_id, text in sorted(data):
        body = (text or "").encode()
        cut = chunks(np.frombuffer(body, np.uint8), np.array([0, len(body)]), 2, 4)
        kept, removed = [], 0
        for a, b, lines in zip(cut.start, cut.end, cut.lines):
            part = body[a:b]
            if lines > 1 and part.strip():
                if part in seen:
                    removed += int(lines)
                    continue
                seen.add(part)
            kept.append(part)
        out[doc_id] = (int(cut.lines.sum()), removed, b"\n".join(kept).decode())
    return out


def line_data():
    rng = np.random.default_rng(4)
    common = [f"shared line {i}" for i in range(30)]
    data = []
    for i in range(60):
        lines = [f"own {i} {k}" for k in range(rng.integers(0, 12))]
        at, first = int(rng.integers(0, len(lines) + 1)), int(rng.integers(0, 10))
        data.append((i, "\n".join(lines[:at] + common[first:] + lines[at:])))
    return data + [(100, None), (101, ""), (102, "\n\n\n\n\n\n"), (103, "\n\n\n\n\n\n"), (104, "shared line 1")]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, -1])
def test_lines(spark, broadcast_bytes):
    data = line_data()
    found = line_dedup(frame(spark, data), broadcast_bytes=broadcast_bytes).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in found} == plain_lines(data)
    assert sum(r.n_removed for r in found) > 300


def test_lines_with_odd_rows(spark):
    found = line_dedup(frame(spark, DATA)).collect()
    assert len(found) == len(DATA)
    assert all(r.n_removed == 0 and (r.kept_text or "") == "" for r in found if r.doc_id in (1000, 1001))
    assert {r.kept_text for r in found if r.doc_id is None} == {DATA[5][1], ""}


def test_line_borders_move_only_near_an_edit():
    lines = [f"line {i}" for i in range(200)]
    edited = lines[:50] + ["put in"] + lines[50:]

    def parts(text):
        body = "\n".join(text).encode()
        cut = chunks(np.frombuffer(body, np.uint8), np.array([0, len(body)]), 2, 4)
        return {body[a:b] for a, b in zip(cut.start, cut.end)}

    assert len(parts(lines) - parts(edited)) <= 3


@pytest.mark.parametrize("operator", [exact_dedup, jaccard_components, substring_dedup, line_dedup])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [], SCHEMA)).count() == 0


@pytest.mark.parametrize("operator", [exact_dedup, jaccard_components, substring_dedup, line_dedup])
def test_only_empty_texts(spark, operator):
    assert operator(frame(spark, [(1, None), (2, ""), (None, None)])).count() == 3


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (102, 101), (7, 7)]
    df = spark.createDataFrame([(str(a).zfill(4), str(b).zfill(4)) for a, b in edges], "a string, b string")
    found = components(df).groupBy("root").count().collect()
    assert sorted(r["count"] for r in found) == [3, 31]
    assert components(df.limit(0)).count() == 0


def test_spread_lookup_of_a_hot_key(spark):
    data = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) AS key")
    table = spark.createDataFrame([("hot", 1), ("k7", 2)], "key string, v int")
    got = spread_lookup(data, table, "key", "id").groupBy("key", "v").count().collect()
    assert {(r.key, r.v) for r in got if r.key in ("hot", "k7", "k8")} == {("hot", 1), ("k7", 2), ("k8", None)}
    assert sum(r["count"] for r in got) == 3000
