"""Training samples.

Random picks order by a hash of the pair and a seed, so they are exact in number
and the same on every run. Samples have a bound in rows; candidates have none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.operators import select


_h = select.pair_hash


def split_by_user(rows: DataFrame, mod: int = 5, rem: int = 0) -> tuple[DataFrame, DataFrame]:
    """Training and validation users; neither side may be empty."""
    valid = F.pmod("user_id", F.lit(mod)) == rem
    parts = rows.where(~valid), rows.where(valid)
    if any(p.isEmpty() for p in parts):
        raise ValueError("a side of the split is empty")
    return parts


def classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P10."""
    return rows.where("label = 1"), rows.where("label = 0")


def class_counts(rows: DataFrame) -> DataFrame:
    """A18."""
    return rows.groupBy("label").agg(F.count("*").alias("n_rows"))


def random_rows(rows: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """M1: exactly ``n`` rows, or all."""
    return rows.orderBy(_h(seed), "user_id", "item_id").limit(n)


def strata(rows: DataFrame) -> DataFrame:
    """``stratum`` of 5 rank bins by 4 score quartiles."""
    rank = F.when(F.col("rn") <= 5, "r5").when(F.col("rn") <= 10, "r10").when(F.col("rn") <= 20, "r20").when(F.col("rn") <= 50, "r50").otherwise("rest")
    p = F.col("pct")
    quartile = F.when(p <= 0.25, "q1").when(p <= 0.5, "q2").when(p <= 0.75, "q3").otherwise("q4")
    return select.score_order(rows).withColumn("stratum", F.concat_ws("_", rank, quartile)).drop("pct")


def quotas(rows: DataFrame, take: int) -> DataFrame:
    """Shares of ``take`` by stratum size, the largest remainders rounded up (ties by name).

    At most 20 rows from the counts on.
    """
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())
    exact = F.least(F.lit(take), total) * F.col("n_rows") / total
    q = sizes.withColumn("exact", exact).withColumn("whole", F.floor("exact").cast("long"))
    left = F.least(F.lit(take), total) - F.sum("whole").over(Window.partitionBy())
    q = q.withColumn("left", left).withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.round(F.col("exact") - F.col("whole"), 9)), "stratum")))
    quota = F.least("n_rows", F.col("whole") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0))
    return q.select("stratum", "n_rows", quota.cast("long").alias("quota"))


def stratified(rows: DataFrame, take: int, seed: int = 42) -> DataFrame:
    """M6: by quota within strata, topped up from the rest if that is short."""
    marked = strata(rows)
    place = F.row_number().over(Window.partitionBy("stratum").orderBy(_h(seed), "user_id", "item_id"))
    placed = marked.join(F.broadcast(quotas(marked, take)).select("stratum", "quota"), "stratum")
    ordered = placed.withColumn("over", F.greatest(place - F.col("quota"), F.lit(0)))
    # rows within quota come first, so a limit tops up
    return ordered.orderBy("over", _h(seed), "user_id", "item_id").limit(take).drop("over", "quota", "stratum")


def hard_and_random(negatives: DataFrame, n: int, hard: int, seed: int = 42, by_strata: bool = False) -> DataFrame:
    """The hardest, and others from the rest; no row twice."""
    first = select.hardest(negatives, hard)
    rest = negatives.join(first.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    other = stratified(rest, n - hard, seed) if by_strata else random_rows(rest, n - hard, seed)
    return first.unionByName(other.select(*first.columns))


def training_rows(rows: DataFrame, ratio: int = 30, mode: str = "mixed", seed: int = 42) -> DataFrame:
    """M1-M4: all positives and ``ratio`` negatives for each; ``mode``: random, hard or mixed (70 % hard)."""
    pos, neg = classes(rows)
    counts = {r.label: r.n_rows for r in class_counts(rows).collect()}
    if not counts.get(1):
        raise ValueError("no positive rows")
    n = min(counts.get(0, 0), counts[1] * ratio)
    if mode == "random":
        picked = random_rows(neg, n, seed)
    elif mode == "hard":
        picked = select.hardest(neg, n)
    else:
        picked = hard_and_random(neg, n, int(0.7 * n), seed)
    return pos.unionByName(picked)


def bounded_rows(rows: DataFrame, max_positives: int = 200_000, max_negatives: int = 600_000, hard_ratio: float = 0.85, seed: int = 42) -> DataFrame:
    """M5: within bounds over all candidates: positives, the hardest negatives, stratified others."""
    pos, neg = classes(rows)
    counts = {r.label: r.n_rows for r in class_counts(rows).collect()}
    if not counts.get(1):
        raise ValueError("no positive rows")
    n = min(counts.get(0, 0), max_negatives)
    parts = [random_rows(pos, max_positives, seed), hard_and_random(neg, n, int(hard_ratio * n), seed, by_strata=True)]
    return reduce(DataFrame.unionByName, parts)


def random_split(rows: DataFrame, valid_ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """M7: ``is_valid`` by hash; the ratio is held within [0.01, 0.40]."""
    share = min(max(valid_ratio, 0.01), 0.40)
    return rows.withColumn("is_valid", F.pmod(_h(seed), F.lit(10_000)) < int(share * 10_000))


def require_both_classes(rows: DataFrame) -> None:
    """A20."""
    if rows.select("label").distinct().count() < 2:
        raise ValueError("rows of both classes are needed")
