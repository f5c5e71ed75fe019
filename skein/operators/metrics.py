"""Label joins and evaluation over grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators import select


def attach_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``label`` 1 where the pair is labelled."""
    known = labels.select("user_id", "item_id").distinct().withColumn("label", F.lit(1))
    return rows.join(known, ["user_id", "item_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def _ratios(counts: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    total = labels.select("user_id", "item_id").distinct().agg(F.count("*").alias("labels"))
    out = counts.crossJoin(F.broadcast(total))  # one row
    precision = F.when(F.col("predictions") > 0, F.col("hits") / F.col("predictions")).otherwise(F.lit(0.0))
    recall = F.when(F.col("labels") > 0, F.col("hits") / F.col("labels")).otherwise(F.lit(0.0))
    out = out.withColumns({"precision": precision, "recall": recall})
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return out.withColumn("f1", f1.otherwise(F.lit(0.0))).select(key, "predictions", "labels", "hits", "precision", "recall", "f1")


def _grid(values: list[int], key: str) -> DataFrame:
    from pyspark.sql import SparkSession

    return F.broadcast(SparkSession.active().createDataFrame([(v,) for v in values], f"{key} long"))


def per_user(scored: DataFrame, labels: DataFrame, grid: list[int], score: str = "score") -> DataFrame:
    """A16 for top k of each user: ranked once at the largest k."""
    rows = attach_labels(select.per_user_topk(scored, max(grid), score), labels)
    by_rank = rows.groupBy("rn").agg(F.count("*").alias("n"), F.sum("label").alias("h"))  # one row a rank
    counts = _grid(grid, "k").join(by_rank, F.col("rn") <= F.col("k"), "left").groupBy("k")
    counts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("predictions"), F.coalesce(F.sum("h"), F.lit(0)).alias("hits"))
    return _ratios(counts, labels, "k")


def global_top(scored: DataFrame, labels: DataFrame, grid: list[int], score: str = "score", user_cap: int = 0) -> DataFrame:
    """A16 for the best n pairs: the pool is cut at the largest n, then capped, then counted for every n.

    The rank over the pool is one window over at most ``max(grid)`` rows.
    """
    from pyspark.sql import Window

    pool = select.global_topn(scored, max(grid), score, user_cap)
    w = Window.orderBy(F.desc(score), "user_id", "item_id")
    rows = attach_labels(pool.withColumn("place", F.row_number().over(w)), labels)
    counts = rows.crossJoin(_grid(grid, "n")).where("place <= n").groupBy("n").agg(F.count("*").alias("predictions"), F.sum("label").alias("hits"))
    every = _grid(grid, "n").join(counts, "n", "left").select("n", F.coalesce("predictions", F.lit(0)).alias("predictions"), F.coalesce("hits", F.lit(0)).alias("hits"))
    return _ratios(every, labels, "n")


def best(metrics: DataFrame, key: str) -> DataFrame:
    """The highest F1, the smallest grid value among equals."""
    return metrics.orderBy(F.desc("f1"), key).limit(1)
