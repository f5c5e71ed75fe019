"""The data profile (A10-A13, P2): one pass a table, exact counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.scalars import day, missing


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def items_profile(items: DataFrame) -> DataFrame:
    """Rows, distinct items and categories, missing places."""
    gone = F.sum(F.when(missing(F.col("item_geohash")), 1).otherwise(0))
    return items.agg(
        F.count("*").alias("n_rows"), F.count_distinct("item_id").alias("n_items"), F.count_distinct("item_category").alias("n_categories"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_missing_geohash"), _ratio(gone, F.count("*")).alias("missing_ratio"),
    )


def log_profile(log: DataFrame, unique: bool = True) -> DataFrame:
    """Rows, missing places, first and last day; with ``unique`` the distinct users, items and categories too."""
    gone = F.sum(F.when(missing(F.col("user_geohash")), 1).otherwise(0))
    counts = [F.count_distinct(c).alias(f"n_{n}") for c, n in (("user_id", "users"), ("item_id", "items"), ("item_category", "categories"))]
    return log.agg(
        F.count("*").alias("n_rows"), F.coalesce(gone, F.lit(0)).cast("long").alias("n_missing_geohash"), _ratio(gone, F.count("*")).alias("missing_ratio"),
        F.min(day(F.col("time"))).alias("first_day"), F.max(day(F.col("time"))).alias("last_day"), *(counts if unique else []),
    )


def behavior_histogram(log: DataFrame) -> DataFrame:
    return log.groupBy(F.col("behavior_type").cast("int").alias("behavior_type")).agg(F.count("*").alias("n_rows"))


def target_ratio(log: DataFrame, items: DataFrame) -> DataFrame:
    """How many rows are about the item subset."""
    ids = items.select("item_id").distinct().withColumn("hit", F.lit(1))
    hits = F.coalesce(F.sum("hit"), F.lit(0))
    return log.join(ids, "item_id", "left").agg(F.count("*").alias("n_rows"), hits.cast("long").alias("n_target"), _ratio(hits, F.count("*")).alias("target_ratio"))
