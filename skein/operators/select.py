"""Selection (T1-T8, W1, W11-W13, P5, P6): rankings per user, global, and with a cap per user.

Rankings per user filter on a row number, which Spark turns into a limit inside
each group before the shuffle; global ones are ordered limits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.sources import work


def ranked(scored: DataFrame, score: str = "score") -> DataFrame:
    """``rn`` within a user: falling score, then item."""
    w = Window.partitionBy("user_id").orderBy(F.desc(score), "item_id")
    return scored.withColumn("rn", F.row_number().over(w))


def per_user_topk(scored: DataFrame, k: int, score: str = "score", min_score: float | None = None) -> DataFrame:
    """T1, T3; P5: the least score holds before ranking."""
    rows = scored if min_score is None else scored.where(F.col(score) >= min_score)
    return ranked(rows, score).where(F.col("rn") <= k)


def _global(score: str):
    return F.desc(score), F.asc("user_id"), F.asc("item_id")


def global_topn(scored: DataFrame, n: int, score: str = "score", user_cap: int = 0, pool_n: int | None = None) -> DataFrame:
    """The best ``n`` pairs; with a cap, at most so many of a user.

    The cap works on the best ``pool_n`` pairs (``n`` where it is not given), so fewer
    than ``n`` may be left.
    """
    if not user_cap:
        return scored.orderBy(*_global(score)).limit(n)
    pool = scored.orderBy(*_global(score)).limit(pool_n or n)
    w = Window.partitionBy("user_id").orderBy(F.desc(score), "item_id")
    return pool.withColumn("of_user", F.row_number().over(w)).where(F.col("of_user") <= user_cap).drop("of_user").orderBy(*_global(score)).limit(n)


def first_rows(candidates: DataFrame, n: int) -> DataFrame:
    """The rows within a budget, by user and rank."""
    return candidates.orderBy("user_id", "rn").limit(n)


def hardest(candidates: DataFrame, n: int) -> DataFrame:
    """Low rank first, then falling score."""
    return candidates.orderBy("rn", F.desc("score"), "user_id").limit(n)


def shuffled(rows: DataFrame, seed: int = 42) -> DataFrame:
    """By a hash of the pair, so reruns agree."""
    return rows.orderBy(pair_hash(seed), "user_id", "item_id")


def pair_hash(seed: int):
    """A number below 2**60 from the pair and a seed, by md5: other engines have it too."""
    named = F.concat_ws(":", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")


def score_order(rows: DataFrame, score: str = "score") -> DataFrame:
    """``pct``, the share of rows up to this one by rising score (ties: user, item).

    Rows are range-partitioned by score, user and item and written; each partition is ordered on its own, and
    the number of rows before it is added. One row a partition reaches the driver, and no task has all rows.
    """
    spark, keys = rows.sparkSession, (score, "user_id", "item_id")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = work.written(rows.repartitionByRange(n, *keys).withColumn("__part", F.spark_partition_id()), "score-order")
    before, total = [], 0
    for part, size in sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect()):
        before.append((part, total))
        total += size
    begins = F.broadcast(spark.createDataFrame(before, "__part int, __before long"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*keys))
    return placed.withColumn("__k", inside).join(begins, "__part").withColumn("pct", (F.col("__before") + F.col("__k")) / F.lit(max(1, total))).select(*rows.columns, "pct")
