import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickweave.operators.observations import explode_features, parse_observations
from clickweave.operators.splits import hash_split, random_split, split_counts
from clickweave.plans import scratch
from clickweave.sources import derived
from clickweave.sources.lines import load_lines, normalize_lines, preview, row_count_check


def _lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "obs_id bigint, line string")


def test_load_plain_and_gzip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("0\ta\t\n1,b,c\n")
    with gzip.open(tmp_path / "in" / "b.txt.gz", "wt") as f:
        f.write("1,d,\n")
    loaded = load_lines(spark, str(tmp_path / "in"))
    rows = loaded.collect()
    assert sorted(r["line"] for r in rows) == ["0\ta\t", "1,b,c", "1,d,"]
    assert len({r["obs_id"] for r in rows}) == 3
    # staged: the ids do not depend on how it is read again
    again = {r["line"]: r["obs_id"] for r in loaded.repartition(5).collect()}
    assert again == {r["line"]: r["obs_id"] for r in rows}


def test_both_delimiters_and_empty_fields(spark):
    lines = normalize_lines(_lines(spark, "0,a,,", "1\tb\t\tc", "1"))
    parsed = {r["obs_id"]: r for r in parse_observations(lines).collect()}
    assert parsed[0]["feats"] == ["a", "", ""] and parsed[0]["label"] == 0.0
    assert parsed[1]["feats"] == ["b", "", "c"] and parsed[1]["label"] == 1.0
    assert parsed[2]["feats"] == []
    single = explode_features(parse_observations(lines)).collect()
    assert [(r["feature_id"], r["value"]) for r in single if r["obs_id"] == 1] == [(0, "b"), (1, ""), (2, "c")]


def test_bad_label_fails(spark):
    with pytest.raises(PySparkException):
        parse_observations(_lines(spark, "x,a")).collect()


def test_preview_and_count(spark):
    lines = _lines(spark, *[f"0,{i}" for i in range(20)]).repartition(6)
    assert [r["obs_id"] for r in preview(lines, 3).collect()] == [0, 1, 2]
    assert row_count_check(lines, 20).first().asDict() == {"actual": 20, "expected": 20, "ok": True}
    assert row_count_check(lines, 21).first()["ok"] is False


def test_hash_split_is_stable_disjoint_and_covering(spark):
    rows = spark.range(20000).withColumnRenamed("id", "obs_id")
    first = {r["obs_id"]: r["split"] for r in hash_split(rows).collect()}
    second = {r["obs_id"]: r["split"] for r in hash_split(rows.repartition(13)).collect()}
    assert first == second and len(first) == 20000
    counts = {r["split"]: r["n"] for r in split_counts(hash_split(rows)).collect()}
    assert counts["train"] == pytest.approx(16000, abs=300)
    assert counts["validation"] == pytest.approx(2000, abs=200)
    other = {r["obs_id"]: r["split"] for r in hash_split(rows, seed=7).collect()}
    assert other != first


def test_random_split_covers(spark):
    rows = spark.range(5000).withColumnRenamed("id", "obs_id")
    parts = [{r["obs_id"] for r in part.collect()} for part in random_split(rows).values()]
    assert sum(map(len, parts)) == 5000 and len(set().union(*parts)) == 5000


def test_random_split_draws_once(spark):
    """All parts read one written table, so an unstable input cannot change between them."""
    rows = spark.range(2000).repartition(5).withColumn("x", F.rand())
    parts = random_split(rows)
    files = {f for part in parts.values() for f in part.inputFiles()}
    assert files == set(parts["train"].inputFiles())
    assert sum(part.count() for part in parts.values()) == 2000


def test_null_columns_keep_later_fields_in_place(spark, tmp_path):
    documents = [(1, None, None, "src", 700), (2, None, "en", "src", 100)]
    spark.createDataFrame(
        documents, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    lines = {r["obs_id"]: r["line"] for r in derived.document_features(spark, str(tmp_path)).collect()}
    assert lines == {1: "0,,src,1", 2: "0,en,src,0"}


def test_the_shared_folder_is_honoured(spark, tmp_path):
    """The setting comes first, then the checkpoint folder; without either only local mode goes on."""

    class Context:
        master, applicationId = "spark://somewhere:1", "app"

        def __init__(self, folder=None):
            self.folder = folder

        def getCheckpointDir(self):
            return self.folder

    class Conf:
        def __init__(self, value=None):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    def session(conf=None, folder=None, master=None):
        made = type("Session", (), {"conf": Conf(conf), "sparkContext": Context(folder)})()
        made.sparkContext.master = master or made.sparkContext.master
        return made

    assert scratch.scratch_root(session("hdfs:/x/", "hdfs:/y")) == "hdfs:/x"
    assert scratch.scratch_root(session(None, "hdfs:/y")) == "hdfs:/y"
    for master in ("spark://h:1", "yarn", "local-cluster[2,1,512]"):
        with pytest.raises(RuntimeError, match="shared folder"):
            scratch.scratch_root(session(master=master))
    for master in ("local", "local[4]", "local[*]"):
        assert scratch.scratch_root(session(master=master))


def test_discard(spark, tmp_path):
    path = f"{tmp_path}/table"
    scratch.materialize(spark.range(3).toDF("id"), "table", path)
    scratch.discard(spark, path)
    assert not (tmp_path / "table").exists()


def write_gzip(spark, path, n):
    text = spark.range(n).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    text.coalesce(1).write.option("compression", "gzip").text(path)


@pytest.mark.parametrize("partitions", [2, 4, 13])
def test_one_gzip_stream_is_shared(spark, tmp_path, partitions):
    write_gzip(spark, f"{tmp_path}/in", 5000)
    loaded = load_lines(spark, f"{tmp_path}/in", min_partitions=partitions)
    assert loaded.rdd.getNumPartitions() >= partitions
    found = loaded.withColumn("part", F.spark_partition_id()).collect()
    sizes = [sum(r.part == k for r in found) for k in {r.part for r in found}]
    assert len(sizes) >= partitions and max(sizes) <= 2 * min(sizes)
    assert len({r.obs_id for r in found}) == 5000 == len({r.line for r in found})
    # ids are fixed, in the order of the lines
    again = {r.line: r.obs_id for r in loaded.collect()}
    assert again == {r.line: r.obs_id for r in found}
    assert sorted(again, key=again.get) == [f"line {i}" for i in range(5000)]


def test_a_long_stream_is_cut_by_bytes_without_a_shuffle(spark, tmp_path):
    text = spark.range(60000).select(F.concat_ws(" ", *[F.md5((F.col("id") * k).cast("string")) for k in range(1, 5)]))
    text.coalesce(1).write.option("compression", "gzip").text(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        loaded = load_lines(spark, f"{tmp_path}/in", min_partitions=2, block_bytes=1 << 20)
        assert "Exchange" not in loaded._jdf.queryExecution().executedPlan().toString()
        parts = loaded.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) >= 4 and max(r["count"] for r in parts) < 30000
        assert sum(r["count"] for r in parts) == 60000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_staging_where_asked(spark, tmp_path):
    write_gzip(spark, f"{tmp_path}/in", 10)
    for partitions, name in ((1, "one"), (3, "three")):
        loaded = load_lines(spark, f"{tmp_path}/in", stage_path=f"{tmp_path}/{name}", min_partitions=partitions)
        assert loaded.count() == 10 and all(f"/{name}/" in f for f in loaded.inputFiles())
