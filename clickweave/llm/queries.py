"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.decontaminate import find_benchmark, hit_words
from clickweave.llm.exact import exact_dedup
from clickweave.llm.html import extract_text
from clickweave.llm.jaccard import jaccard_components
from clickweave.llm.language import LanguageModel, fit_languages, predict_languages
from clickweave.llm.lines import line_dedup
from clickweave.llm.oracles import ORACLES
from clickweave.llm.packing import pack_documents, word_lengths
from clickweave.llm.personal import BASE_KINDS, find_personal, fit_personal
from clickweave.llm.secrets import find_secrets, fit_tagger
from clickweave.llm.substring import substring_dedup
from clickweave.llm.toxicity import fit_toxicity, score_toxicity
from clickweave.llm.variants import count_words, group_variants
from clickweave.llm.whitening import fit_whitening, whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def _joined_spans(spans: Column) -> Column:
    written = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(written, ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = find_secrets(docs, fit_tagger(docs))
    base = F.filter("spans", lambda s: s["kind"] != "tagged")
    return found.select(
        "doc.doc_id",
        _count("assign"),
        _count("access"),
        _count("hex"),
        F.sha2(_joined_spans(base), 256).alias("base_sha256"),
        _joined_spans(F.col("spans")).alias("spans"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = hit_words(F.col("spans"))
    return found.select(
        "doc.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id") -> Column:
    """One of five rows, by id, that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5, F.lit(1)) == 0


def language_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """The language model, learned from rows that are not held out."""
    return fit_languages(_table(spark, sf_dir, "documents").where(~held_out()))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = predict_languages(_table(spark, sf_dir, "documents"), language_model(spark, sf_dir))
    return found.select("doc.doc_id", held_out("doc.doc_id").alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels").where(~held_out()))
    return score_toxicity(docs, model).select(
        "doc.doc_id",
        held_out("doc.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(word_lengths(_table(spark, sf_dir, "documents")).select("doc.doc_id", "length"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    model = fit_whitening(vectors)
    found = whiten(vectors, model)
    share = [float(e / model.trace) for e in model.eigenvalues] if model else []
    explained = F.array(*[F.lit(s) for s in share]).cast("array<double>")
    return found.select("doc.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        # a long holds it while n is under some ten million
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = find_personal(docs, fit_personal(docs))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc.doc_id",
        *[_count(kind) for kind in BASE_KINDS],
        F.sha2(_joined_spans(base), 256).alias("base_sha256"),
        _joined_spans(F.col("spans")).alias("spans"),
    )


# every word whose hash this divides is spoiled, so that there are variants to find
TYPO_EVERY = 31


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_words(_table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY)
    return group_variants(counts).select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_secret_scan": op2_secret_scan,
        "op3_line_dedup": op3_line_dedup,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
        "op6_language_id": op6_language_id,
        "op7_toxicity": op7_toxicity,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_personal_data": op12_personal_data,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
