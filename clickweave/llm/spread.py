"""Helpers that keep frequent keys from becoming one task's work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.plans.scratch import discard, materialize, scratch_path


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_lookup(rows: DataFrame, table: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows`` left join ``table`` (unique on ``key``), dealt by key and a class of ``spread``.

    The table is first joined to the distinct (key, class) pairs of the rows;
    there are at most as many classes as reduce tasks, so no task gets more
    rows of one key than its share, and no row of the table is copied for
    classes that do not occur.
    """
    slot = F.pmod(F.xxhash64(spread), F.lit(tasks(rows.sparkSession))).alias("_slot")
    dealt = rows.select("*", slot)
    answers = dealt.select(key, "_slot").distinct().join(table, key)
    return dealt.join(answers, [key, "_slot"], "left").drop("_slot")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (node, root) per node, any root of its own.

    Every round moves each node to its smallest neighbour and contracts the
    edges, so they shrink geometrically; combination happens before each
    exchange.  The tables of a round are written to the shared folder, which
    ends its lineage, and go when the next round is written.
    """
    spark = edges.sparkSession
    written: dict[str, str] = {}

    def keep(table: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"components-{name}")
        kept = materialize(table, name, path)
        if name in written:
            discard(spark, written[name])
        written[name] = path
        return kept

    edges = keep(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mapping = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    first = True
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = keep(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")), "parents")
        if first:
            moved = parents.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            step = parents.select(F.col("a").alias("root"), "p")
            moved = mapping.join(step, "root", "left").select("node", F.coalesce("p", "root").alias("root"))
        mapping, first = keep(moved, "mapping"), False
        one = parents.select("a", F.col("p").alias("pa"))
        other = parents.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        ends = edges.join(one, "a").join(other, "b").where("pa <> pb")
        edges = keep(ends.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    return mapping
