"""The queries of this sub-package: each operator on its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import decontamination, line_templates, mixing, near_duplicates, pii, quality, substring, token_counts, token_files, toxicity


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; ``SKEIN_TOKENIZERS`` names another folder than the installed package's."""
    folder = os.environ.get("SKEIN_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_files.read(spark, path)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = toxicity.fold(F.col("doc_id")) == 2
    return toxicity.scored(docs, classifier).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.per_document(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_taken")).cast("long").alias("taken"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = substring.with_removals(table(spark, sf_dir, "documents"))
    numbers = [F.coalesce(F.col(f"__gone.{c}"), F.lit(0)).cast("long").alias(c) for c in ("n_removed", "removed_words", "removed_chars")]
    spans = F.array_join(F.transform("__gone.spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return marked.select(F.col("doc_id").cast("long").alias("doc_id"), *numbers, F.coalesce(spans, F.lit("")).alias("spans"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_token_files, op2_decontamination, op3_toxicity, op4_near_duplicates, op5_quality,
        op6_token_counts, op7_pii, op8_line_templates, op9_mixing, op10_substrings, pipeline,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op5_quality": quality.oracle_sql(), "op8_line_templates": line_templates.oracle_sql(), "op9_mixing": mixing.oracle_sql(), "op10_substrings": substring.oracle_sql()}
