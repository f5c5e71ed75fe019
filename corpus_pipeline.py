"""From raw documents to token files: five stages, each one operator on all that the stage before kept.

quality rules -> near-duplicate removal -> benchmark decontamination -> mixing
sources to target weights -> token-id files. Each stage is a function of
(spark, docs, sf_dir); what it returns is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``.
The last writes the binary files and returns what they hold, read back.

The mix repeats a document's row as often as it takes it, so the token files
hold it as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skein.llm import decontamination, mixing, near_duplicates, quality, token_files
from skein.llm.queries import table, tokenizer_path
from skein.llm.scratch import cleared, delete, new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed, and documents rejected that fail the rules or lose too much text.

    A null or empty text is rejected; rows of equal id are judged one by one.
    """
    return quality.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of least id; one row of each id, and all of null id."""
    return near_duplicates.first_documents(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go; with an empty benchmark all stay."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix takes, as often as it takes them; texts without words are never taken."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Binary files of all texts in ascending order of ids, and what they hold, read back."""
    return token_files.read(spark, token_files.token_files(docs, tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: No SQL states the near-duplicate and encoding stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; what a stage has made for itself is deleted once its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        with cleared(spark):
            out = stage(spark, docs, sf_dir)
            out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
