"""Exact deduplication by a tree merge of digest runs, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.plans.scratch import materialize

FAN_IN = 8
_KEY = ["_sha", "_bytes", "_check"]


def _runs(docs: DataFrame, fan_in: int) -> int:
    """A power of the fan-in, at least as many as there are reduce tasks."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = fan_in
    while runs < tasks:
        runs *= fan_in
    return runs


def exact_dedup(
    docs: DataFrame,
    *,
    keep: str = "largest",
    carry: Sequence[str] = (),
    runs: int | None = None,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document of ``docs(doc_id, text)``: which row of its equal texts stays.

    Returns doc_id, keep_id, group_size, kept, text_sha256 and, if columns are
    named in ``carry``, doc, a struct of them.  Texts are equal when
    identical; a null text counts as empty.  ``keep`` is ``largest`` or
    ``smallest`` (doc_id).  Rows that repeat both id and text count in
    group_size, and one of them stays.  A null doc_id is never kept unless its
    group has no other id (keep_id is then null, and one row stays).  Other
    columns are ignored; an empty table gives no rows.

    The rows are dealt by id into ``runs`` runs of digests, written once, so every
    text is read and digested once.  Each round merges ``fan_in`` runs into one,
    keeping per content its best id and its size, until one run is left.  Content
    is SHA-256 with the length and a second, independent hash as witnesses; they
    are part of the key at every level, so texts that only share a digest stay
    apart.  Equal rows are combined before every exchange and the run is part of
    the key, so a content that fills a third of the table is never one task's
    work, on the way up or down; nor is one row that fills it, as the answers
    come back by a join that Spark splits where a key has many rows.
    """
    best, best_by = {"largest": (F.max, F.max_by), "smallest": (F.min, F.min_by)}[keep]
    runs = runs or _runs(docs, fan_in)
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.unhex(F.sha2(body, 256)).alias("_sha"),
        F.octet_length(body).alias("_bytes"),
        F.xxhash64(body).alias("_check"),
        F.pmod(F.xxhash64("doc_id"), F.lit(runs)).alias("_run"),
        F.monotonically_increasing_id().alias("_row"),
        *([F.struct(*carry).alias("doc")] if carry else []),
    )
    # with this every row has a number of its own for good
    rows = materialize(rows, "digest-runs")
    # of rows that repeat an id and a content, the first; an id stands in one run only
    repeats = rows.groupBy(*_KEY, "_run", "doc_id").agg(F.min("_row").alias("row"), F.count(F.lit(1)).alias("n"))
    leaves = repeats.groupBy(*_KEY, "_run").agg(
        best("doc_id").alias("keep_id"),
        F.coalesce(best_by("row", "doc_id"), F.min("row")).alias("keep_row"),
        F.sum("n").alias("group_size"),
    )
    merged, left = leaves, runs
    while left > 1:
        left = -(-left // fan_in)
        merged = (
            merged.withColumn("_run", F.floor(F.col("_run") / fan_in))
            .groupBy(*_KEY, "_run")
            .agg(
                best("keep_id").alias("keep_id"),
                F.coalesce(best_by("keep_row", "keep_id"), F.min("keep_row")).alias("keep_row"),
                F.sum("group_size").alias("group_size"),
            )
        )
    copies = merged.where("group_size > 1").drop("_run")
    # back down: first to the runs that hold a copied content, then to their rows
    answers = leaves.select(*_KEY, "_run").join(copies, _KEY)
    joined = rows.join(answers, [*_KEY, "_run"], "left")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (single | (F.col("_row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
        *(["doc"] if carry else []),
    )
