"""Click-log shaped lines ``(obs_id, line)`` derived from the relational tables.

Field 0 is the 0/1 label, the rest are categorical strings; an empty string is
a category of its own.  A NULL column is an empty field, so later fields keep
their position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flag(condition: Column) -> Column:
    return F.when(condition, "1").otherwise("0")


def _whole(number: Column) -> Column:
    return F.floor(number).cast("bigint").cast("string")


def _line(delimiter: str, *fields: Column) -> Column:
    return F.concat_ws(delimiter, *[F.coalesce(f, F.lit("")) for f in fields]).alias("line")


def ctr_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated: click?, user, props key, hour, value bucket (may be empty)."""
    value = F.col("value")
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("obs_id"),
        _line(
            "\t",
            _flag(F.col("event_type") == "click"),
            F.col("user_id").cast("string"),
            F.regexp_extract("props", "[0-9]+", 0),
            F.hour("ts").cast("string"),
            F.when(value < 5, "").otherwise(_whole(value)),
        ),
    )


def ctr_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated: fulfilled?, priority, year, month, customer, segment, nation, price bucket."""
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("obs_id"),
        _line(
            ",",
            _flag(F.col("o_orderstatus") == "F"),
            F.col("o_orderpriority"),
            F.year("o_orderdate").cast("string"),
            F.month("o_orderdate").cast("string"),
            F.col("o_custkey").cast("string"),
            F.col("c_mktsegment"),
            F.col("c_nationkey").cast("string"),
            _whole(F.col("o_totalprice") / 10000),
        ),
    )


def ctr_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated: quality label, language, source, length bucket."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("obs_id"),
        _line(
            ",",
            F.col("quality").cast("string"),
            *_document_features(),
        ),
    )


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every document, with or without a label; the label field is 0."""
    documents = _table(spark, sf_dir, "documents")
    return documents.select(F.col("doc_id").alias("obs_id"), _line(",", F.lit("0"), *_document_features()))


def _document_features() -> list[Column]:
    return [F.col("lang"), F.col("source"), _whole(F.col("n_chars") / 500)]
