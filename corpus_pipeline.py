"""The corpus pipeline: quality rules, near-duplicates, substring dedup, source mixing, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import jaccard, mixing, packing, quality, substrings
from tidemill.llm.common import shared_dir
from tidemill.llm.queries import tokenizer_path

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines above their hosts' limits."""
    x = quality.judge_quality(docs).where("kept")
    n = F.when(F.col("n_template") > 0, F.length("cleaned").cast("long")).otherwise(F.col("n_chars"))
    return x.select("doc_id", F.col("cleaned").alias("text"), "lang", "source", n.alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one with the smallest id, then the least text hash.

    Each task keeps the least row of each group it meets before any are shuffled, so a large group is nobody's burden.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "lang", "source", "n_chars")
    x = jaccard.similar_documents(docs).groupBy("component_label").agg(F.min_by(F.struct(*_COLUMNS), order).alias("row"))
    return x.select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; a text that loses nothing stays as it is."""
    x = substrings.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return x.where("n_words = 0 or n_removed < n_words").select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    x = mixing.mix_sources(docs, quality=mixing.letter_share(F.col("text")))
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return x.select(*_COLUMNS, F.explode(F.array_repeat(F.lit(1), times)).alias("_copy")).select(*_COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.best_fit(packing.token_pieces(docs, tokenizer_path()))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: Approximate near-duplicate keys, tokenizers and online packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
