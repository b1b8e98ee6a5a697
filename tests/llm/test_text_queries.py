"""The registered text queries against their SQL, and the pipeline against plain versions."""

from collections import Counter

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from clickweave.llm.queries import oracle_sql, queries
from tests.compare import connect, difference
from tests.llm import brute
from tests.llm.corpus import rows

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = [n.split("_")[0] for n in queries()]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert set(queries()) | {"pipeline"} <= set(driver.queries())
    assert set(oracle_sql()) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, name):
    assert difference(queries()[name](spark, SF_DIR), connect(SF_DIR), oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - {"op11_embedding_whitening"}))
def test_query_returns_a_row_per_document(spark, name):
    found = queries()[name](spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found.select("doc_id").distinct().count() == documents.count()


def test_pipeline(spark, tmp_path):
    """Every stage on a table with odd rows, each against a plain version of what it keeps."""
    data = [r for r in dict.fromkeys(rows()) if r[0] is not None]
    table = [(i, t, "en" if i % 2 else "fr", None, None) for i, t in data]
    spark.createDataFrame(
        table, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(brute.space_words(data[9][1])[:30])), (2, "é ß 中文")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    texts = {i: t for i, t in data if t and any(c.isalpha() for c in t)}
    expected = [sorted(texts)]
    last = {t: i for i, t in sorted(texts.items())}
    expected.append(sorted(last.values()))
    left = [(i, texts[i]) for i in expected[-1]]
    expected.append(sorted(i for i, _, root, _ in brute.jaccard(left, 5, 80) if i == root))
    left = [(i, texts[i]) for i in expected[-1]]
    expected.append(sorted(i for i, _, hit, _ in brute.contamination(left, items, 10) if not hit))

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for (name, stage), ids in zip(corpus_pipeline.STAGES, expected):
        path = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        assert sorted(r.doc_id for r in docs.collect()) == ids, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    lengths = Counter()
    for r in packed:
        lengths[r.doc_id] += r.length
    assert lengths == Counter({i: len(brute.space_words(texts[i])) for i in expected[-1]})
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.part, r.length) for r in whole) == sorted((r.doc_id, r.part, r.length) for r in packed)


def test_pipeline_on_empty_tables(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
