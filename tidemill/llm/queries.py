"""The operators over the given tables, each with its result's digest columns, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, ctw, divergence, fingerprints, infill, jaccard, mixing, packing, pages, quality, substrings, urls, vectors
from .oracles import ORACLE_SQL, TRAP  # noqa: F401

def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packing.best_fit(packing.token_pieces(docs, tokenizer_path()))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    trap = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text"))
    made = chat.format_chat(chat.canonical_turns(rows.select("conv_id", "turn", "role", "text").unionByName(trap)))
    read = chat.parse_chat(made, keep=("formatted",))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard.similar_documents(docs).select("doc_id", "n_shingles", "component_id")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixing.mix_sources(docs, quality=mixing.letter_share(F.col("text"))).select("doc_id", "size", "source_size", "target", "taken")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.filter_urls(rows).select("page_id", "host", "path", "rule", "verdict", "url_score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return quality.judge_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_template", F.sha2(F.coalesce("cleaned", F.lit("")).cast("binary"), 256).alias("cleaned_sha256"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return vectors.near_vectors(rows).select("vec_id", "n_links", "component_id", "kept")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return pages.extract_text(rows).select("page_id", "url", "text", "n_chars")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ctw.score_texts(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = infill.fill_in_middle(infill.frame_texts(docs))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return fingerprints.fingerprint_documents(docs).drop("text")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_best_fit_packing, op2_substring_dedup, op3_chat_formatting, op4_ngram_jaccard_join, op5_source_mixing, op6_url_filters,
        op7_quality_rules, op8_embedding_near_dedup, op9_html_extraction, op10_lm_scoring, op11_fill_in_middle, op12_source_divergence,
        op13_document_fingerprints, pipeline,
    )
    return {f.__name__: f for f in own}

