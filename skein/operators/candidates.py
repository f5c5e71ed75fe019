"""Candidates with statistics and feature tables.

Statistics are over the candidates left after the rank cut, so they depend on K.
The user's ranking, cut and statistics share one shuffle; the item's statistics
cost one more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.scalars import UNIT
from skein.operators import select
from skein.schema import COUNTS, NO_CATEGORY, NO_GAP

#: Prefixes of the joined feature tables.
PREFIX = {"pair": "p", "user": "u", "item": "i", "category": "c", "user_category": "uc"}


def base(scores: DataFrame, k: int) -> DataFrame:
    """The best ``k`` items of each user, with user and item statistics; ``scores`` has ``units``."""
    top = select.per_user_topk(scores, k).withColumn("rn", F.col("rn").cast("long"))
    user, item = Window.partitionBy("user_id"), Window.partitionBy("item_id")
    unit = F.lit(float(UNIT))
    square = F.col("score") * F.col("score")
    return top.withColumns({
        "user_score_max": F.max("score").over(user), "user_score_sum": F.sum("units").over(user) / unit,
        "user_score_mean": F.sum("units").over(user) / F.count("*").over(user) / unit, "user_score_sq_sum": F.sum(square).over(user),
        "user_candidate_count": F.count("*").over(user),
    }).withColumns({
        "item_score_max": F.max("score").over(item), "item_score_mean": F.sum("units").over(item) / F.count("*").over(item) / unit,
        "item_score_sq_sum": F.sum(square).over(item), "item_candidate_user_count": F.count("*").over(item),
    })


def fallback_stats(candidates: DataFrame) -> DataFrame:
    """Statistics from the rows themselves, where the live ones are not there; sample deviations, 0 for one row."""
    user = candidates.groupBy("user_id").agg(
        F.max("score").alias("user_score_max"), F.sum("score").alias("user_score_sum"), F.avg("score").alias("user_score_mean"),
        F.coalesce(F.stddev_samp("score"), F.lit(0.0)).alias("user_score_std"), F.count("*").alias("user_candidate_count"),
    )
    item = candidates.groupBy("item_id").agg(
        F.max("score").alias("item_score_max"), F.avg("score").alias("item_score_mean"),
        F.coalesce(F.stddev_samp("score"), F.lit(0.0)).alias("item_score_std"), F.count("*").alias("item_candidate_user_count"),
    )
    return candidates.join(user, "user_id", "left").join(item, "item_id", "left")


def _measures(table: DataFrame, prefix: str, keys: tuple[str, ...]) -> DataFrame:
    names = ("last_hours_gap", *(n for n, _, _ in COUNTS))
    return table.select(*keys, *(F.col(n).alias(f"{prefix}_{n}") for n in names))


def _filled(prefix: str) -> dict:
    gap = f"{prefix}_last_hours_gap"
    return {gap: F.coalesce(gap, F.lit(NO_GAP))} | {f"{prefix}_{n}": F.coalesce(f"{prefix}_{n}", F.lit(0).cast("long")) for n, _, _ in COUNTS}


def full(scores: DataFrame, k: int, tables: dict[str, DataFrame], category_map: DataFrame | None = None) -> DataFrame:
    """Left joins with the feature tables that there are (any of the scopes).

    The category tables join on the item's category in the map before missing
    categories become -1, so an item without one matches nothing.
    """
    out = base(scores, k)
    for scope, keys in (("pair", ("user_id", "item_id")), ("user", ("user_id",)), ("item", ("item_id",))):
        if scope in tables:
            out = out.join(_measures(tables[scope], PREFIX[scope], keys), list(keys), "left").withColumns(_filled(PREFIX[scope]))
    if category_map is None:
        return out
    out = out.join(category_map.select("item_id", "item_category"), "item_id", "left")
    for scope, keys in (("category", ("item_category",)), ("user_category", ("user_id", "item_category"))):
        if scope in tables:
            out = out.join(_measures(tables[scope], PREFIX[scope], keys), list(keys), "left").withColumns(_filled(PREFIX[scope]))
    return out.withColumn("item_category", F.coalesce("item_category", F.lit(NO_CATEGORY)))
