"""From raw documents to packed training sequences.

Every stage takes the documents its predecessor kept and returns the ones it
keeps, whole and with all their columns; the last returns where each goes.
doc_id identifies a document; rows without one cannot be told apart by the
near-duplicate stage and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.decontaminate import find_benchmark
from clickweave.llm.exact import exact_dedup
from clickweave.llm.jaccard import jaccard_components
from clickweave.llm.language import UNDETERMINED, fit_languages, predict_languages
from clickweave.llm.packing import pack_documents, word_lengths
from clickweave.llm.queries import held_out
from clickweave.plans.lookup import anti_lookup, fits
from clickweave.plans.scratch import materialize

# ids that a stage removes are broadcast while they take no more than this
REMOVED_BYTES = 16 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: empty ones and those without a letter."""
    model = fit_languages(docs.where(~held_out()))
    found = predict_languages(docs, model, carry=docs.columns)
    return found.where(F.col("lang_pred") != UNDETERMINED).select("doc.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, the one with the largest id."""
    return exact_dedup(docs, carry=docs.columns).where("kept").select("doc.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one with the smallest id."""
    removed = jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    removed = materialize(removed, "near-removed")
    if fits(removed, REMOVED_BYTES):
        return anti_lookup(docs, removed, ["doc_id"], small=True)
    return docs.join(removed.hint("shuffle_hash"), "doc_id", "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_benchmark(docs, benchmark, carry=docs.columns)
    return found.where(F.size("spans") == 0).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return pack_documents(word_lengths(docs).select("doc.doc_id", "length"))


STAGES = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# a language model and a packing plan have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
