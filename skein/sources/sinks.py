"""Writing results (S11-S16) and checking a submission (V1)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import select


def write_tsv(pairs: DataFrame, path: str) -> None:
    """Two columns, tab-separated, no header, no duplicates."""
    pairs.select("user_id", "item_id").distinct().write.mode("overwrite").csv(path, sep="\t", header=False)


def export_per_user(scored: DataFrame, k: int, path: str, score: str = "score") -> None:
    """S11."""
    write_tsv(select.per_user_topk(scored, k, score), path)


def export_global(scored: DataFrame, n: int, path: str, score: str = "score", user_cap: int = 0, pool_n: int | None = None) -> None:
    """S12."""
    write_tsv(select.global_topn(scored, n, score, user_cap, pool_n), path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file, on whatever file system the path is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(conf).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_json(spark: SparkSession, summary: dict, path: str) -> None:
    """A run's summary."""
    write_text(spark, json.dumps(summary, indent=2, sort_keys=True, default=str), path)


def write_trials(spark: SparkSession, trials: list[dict], path: str) -> None:
    """Trials by falling F1."""
    spark.createDataFrame(trials).orderBy(F.desc("f1")).coalesce(1).write.mode("overwrite").csv(path, header=True)


def markdown(profile: dict[str, list[dict]]) -> str:
    """A report of small tables."""
    out = ["# Data profile", ""]
    for title, rows in profile.items():
        out += [f"## {title}", ""]
        if rows:
            names = list(rows[0])
            out += ["| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
            out += ["| " + " | ".join(str(r[n]) for n in names) + " |" for r in rows]
        out.append("")
    return "\n".join(out)


def check_submission(spark: SparkSession, path: str) -> dict:
    """V1: rows, duplicates, and whether the file has two whole-number columns and no header."""
    lines = spark.read.text(path)
    parts = F.split("value", "\t")
    ok = (F.size(parts) == 2) & F.element_at(parts, 1).rlike(r"^-?[0-9]+$") & F.element_at(parts, -1).rlike(r"^-?[0-9]+$")
    r = lines.agg(F.count("*").alias("rows"), F.count_distinct("value").alias("different"), F.sum(F.when(ok, 0).otherwise(1)).alias("malformed")).first()
    found = {"rows": r["rows"], "duplicates": r["rows"] - r["different"], "malformed": r["malformed"] or 0}
    return found | {"valid": found["rows"] > 0 and not found["duplicates"] and not found["malformed"]}


def save_model(model, path: str) -> None:
    """S16."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
