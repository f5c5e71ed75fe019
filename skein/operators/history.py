"""History tables for one target day.

History is the half-open range [target - lookback, target): the target day is no
history. Scores are sums of whole units, so they do not depend on the order of
rows. All aggregates have partial sums, so a hot user or item is reduced before
the shuffle.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.scalars import UNIT, day, days_before, decayed_units, hour, hours_gap
from skein.schema import COUNTS, PURCHASE, WEIGHTS


def of_items(log: DataFrame, items: DataFrame) -> DataFrame:
    """Rows about the item subset, before anything is aggregated; Spark picks the join by the subset's size."""
    return log.join(items.select("item_id").where("item_id IS NOT NULL").distinct(), "item_id", "left_semi")


def labels(rows: DataFrame, target: str) -> DataFrame:
    """Pairs bought on the target day; a prefix of the time reaches the scan, a function of it does not."""
    return rows.where(F.col("time").startswith(target) & (F.col("behavior_type") == PURCHASE)).select("user_id", "item_id").distinct()


def history(rows: DataFrame, target: str, lookback: int = 14) -> DataFrame:
    """The rows before the target day, with ``days`` and ``gap`` to it.

    Times order as texts, so the range is on the column itself and reaches the scan.
    """
    date, first = day(F.col("time")), (datetime.date.fromisoformat(target) - datetime.timedelta(lookback)).isoformat()
    inside = rows.where((F.col("time") >= first) & (F.col("time") < target))
    days = days_before(date, target)
    return inside.select(
        "user_id", "item_id", F.col("behavior_type").cast("int").alias("behavior_type"), "item_category", days.alias("days"),
        hours_gap(days, hour(F.col("time"))).alias("gap"),
    )


def scores(past: DataFrame, decay: float = 0.85, weights: dict[int, float] = WEIGHTS) -> DataFrame:
    """A1, A2: the decayed score of each pair, in units and as a number."""
    units = F.sum(decayed_units(F.col("behavior_type"), F.col("days"), decay, weights))
    return past.groupBy("user_id", "item_id").agg(units.alias("units")).withColumn("score", F.col("units") / F.lit(float(UNIT)))


def _measures():
    gap = F.min("gap").cast("int").alias("last_hours_gap")
    counts = [F.sum(F.when((F.col("behavior_type") == b) & (F.col("days") <= w), 1).otherwise(0)).cast("long").alias(n) for n, b, w in COUNTS]
    return gap, *counts


#: Feature tables by their keys.
SCOPES = {
    "pair": ("user_id", "item_id"),
    "user": ("user_id",),
    "item": ("item_id",),
    "category": ("item_category",),
    "user_category": ("user_id", "item_category"),
}


def features_of(past: DataFrame, scope: str) -> DataFrame:
    """The least gap and 16 counts by the keys of a scope."""
    return past.groupBy(*SCOPES[scope]).agg(*_measures())


def feature_cube(past: DataFrame) -> DataFrame:
    """A3-A7 in one pass: grouping sets with ``scope`` naming the set."""
    keys = ("user_id", "item_id", "item_category")
    sets = [[F.col(k) for k in v] for v in SCOPES.values()]
    scope = F.grouping_id()
    # a key that is aggregated away sets its bit, the first key the highest
    ids = {sum(4 >> i for i, k in enumerate(keys) if k not in v): s for s, v in SCOPES.items()}
    name = F
    for number, s in ids.items():
        name = name.when(scope == number, F.lit(s))
    return past.groupingSets(sets, *keys).agg(name.alias("scope"), *_measures())


def daily(past: DataFrame) -> DataFrame:
    """Mergeable partials; sums and minima of several days' partials are those of all their rows."""
    return past.groupBy("user_id", "item_id", "item_category", "behavior_type", "days").agg(F.count("*").alias("n"), F.min("gap").alias("gap"))


def features_of_daily(partials: DataFrame, scope: str) -> DataFrame:
    """A feature table from partials, whatever number of them."""
    counts = [F.sum(F.when((F.col("behavior_type") == b) & (F.col("days") <= w), F.col("n")).otherwise(0)).cast("long").alias(n) for n, b, w in COUNTS]
    return partials.groupBy(*SCOPES[scope]).agg(F.min("gap").cast("int").alias("last_hours_gap"), *counts)


def scores_of_daily(partials: DataFrame, decay: float = 0.85, weights: dict[int, float] = WEIGHTS) -> DataFrame:
    """A2: the scores from partials; whole units, so equal to those of the rows."""
    units = F.sum(decayed_units(F.col("behavior_type"), F.col("days"), decay, weights) * F.col("n"))
    return partials.groupBy("user_id", "item_id").agg(units.alias("units")).withColumn("score", F.col("units") / F.lit(float(UNIT)))


def active_users(past: DataFrame) -> DataFrame:
    """A9."""
    return past.select("user_id").distinct()


def item_category_map(rows: DataFrame) -> DataFrame:
    """Each item's category by its earliest row, the target day and later included (ties: the least category)."""
    first = F.min(F.struct("time", "item_category"))
    return rows.groupBy("item_id").agg(first.alias("x")).select("item_id", F.col("x.item_category").alias("item_category"))
