"""Every query of the library by name, with the SQL that DuckDB checks it by.

The fixture's ``events`` stand for a behaviour log; the target day and the other
parameters are the same on both sides. Both sides sum scores in whole units, so
they agree to the last digit; ratios are rounded to 6 places. The SQL states every
formula on its own, not from the library's expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import candidates, features, history, metrics, model, profile, sampling, select
from skein.plans import flows
from skein.schema import COUNTS
from skein.sources import logs, work
from skein.streaming import incremental

TARGET, LOOKBACK, K = "2024-01-29", 14, 10
N_GRID, K_GRID = [20, 50, 100, 200], [5, 10, 20]
RULES = features.Rules(zombie_click_threshold=5.0)


class Fixture:
    """The lazy tables of one fixture folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.log = logs.events_log(spark.read.parquet(f"{sf_dir}/events.parquet"))
        self.items = logs.events_items(self.log)
        self.rows = history.of_items(self.log, self.items)
        self.past = history.history(self.rows, TARGET, LOOKBACK)
        self.scores = history.scores(self.past)
        self.labels = history.labels(self.rows, TARGET)

    def tables(self) -> flows.Tables:
        return flows.Tables.build(self.log, self.items, TARGET, LOOKBACK)

    def base(self, k: int = K) -> DataFrame:
        return candidates.base(self.scores, k)

    def full(self, k: int = K) -> DataFrame:
        return self.tables().candidates(k)

    def pseudo(self, k: int = K) -> DataFrame:
        """Candidates with a probability that needs no model: the score over the user's best."""
        return self.full(k).withColumn("p", F.col("score") / (F.col("user_score_max") + F.lit(1e-6)))

    def hybrid(self, rules: features.Rules = RULES) -> DataFrame:
        return features.hybrid(self.pseudo(), "p", rules).withColumn("hybrid", F.round("hybrid", 6))

    def labelled(self) -> DataFrame:
        return metrics.attach_labels(self.full(), self.labels)


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


_COUNT_NAMES = [n for n, _, _ in COUNTS]


def _feature_query(enhanced: bool, pick: Callable[[str], bool]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        built, names = features.build(Fixture(spark, sf_dir).full(), enhanced)
        chosen = [n for n in names if pick(n)]
        return built.select("user_id", "item_id", *(F.round(n, 6).alias(f"f_{n}") for n in chosen))

    return run


def _is_share(n: str) -> bool:
    return "_share_" in n


def _is_ratio(n: str) -> bool:
    return "ratio" in n or "engage" in n or n.endswith("_inv")


_ENHANCED = sorted(set(features.registry(True)) - set(features.registry(False)))
_BASE = ("score", "rn", "log_score", "user_score_std", "item_score_std", "rank_inv", "rank_pct", "score_div_user_max", "score_div_user_sum", "score_minus_user_mean", "score_minus_item_mean", "user_candidate_count_log", "item_candidate_user_count_log", "user_score_mean", "user_candidate_count", "item_score_mean", "item_candidate_user_count")
_STATS = ("user_score_max", "user_score_sum", "user_score_mean", "user_score_sq_sum", "item_score_max", "item_score_mean", "item_score_sq_sum")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's best candidates with their statistics."""
    return Fixture(spark, sf_dir).base().drop("units")


def _q_feature_cube(f: Fixture) -> DataFrame:
    keys = [F.coalesce(k, F.lit(-1)).alias(k) for k in ("user_id", "item_id", "item_category")]
    return history.feature_cube(f.past).select("scope", *keys, "last_hours_gap", *_COUNT_NAMES)


def _q_submission(f: Fixture) -> DataFrame:
    pairs = select.per_user_topk(f.scores, K).select("user_id", "item_id")
    return pairs.agg(F.count("*").alias("n_rows"), F.count_distinct("user_id", "item_id").alias("n_pairs"), F.count_distinct("user_id").alias("n_users"))


def _q_strategy(f: Fixture) -> DataFrame:
    a = metrics.best(metrics.per_user(f.hybrid(), f.labels, [5, 10], "hybrid"), "k").select(F.lit("per_user").alias("strategy"), F.col("k").alias("cut"), "f1")
    b = metrics.best(metrics.global_top(f.hybrid(), f.labels, N_GRID, "hybrid"), "n").select(F.lit("global").alias("strategy"), F.col("n").alias("cut"), "f1")
    return _round(a.unionByName(b).orderBy(F.desc("f1"), F.desc("strategy")).limit(1), "f1")


def _q_split(f: Fixture) -> DataFrame:
    train, valid = sampling.split_by_user(f.base(), 5, 0)
    return train.agg(F.lit("train").alias("part"), F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("n_users")).unionByName(
        valid.agg(F.lit("valid").alias("part"), F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("n_users"))
    )


def _q_gate(f: Fixture) -> DataFrame:
    m = metrics.global_top(f.hybrid(), f.labels, N_GRID, "hybrid")
    return _round(m.select("n", "f1", flows.gate_column(F.col("f1")).alias("gate")), "f1")


def _q_sample_counts(f: Fixture) -> DataFrame:
    return sampling.class_counts(sampling.training_rows(f.labelled(), 3, "mixed"))


def _q_bounded_counts(f: Fixture) -> DataFrame:
    return sampling.class_counts(sampling.bounded_rows(f.labelled(), 10, 100))


def _q_non_finite(f: Fixture) -> DataFrame:
    """Features of candidates with missing means and infinite scores, counted before they are made finite."""
    full = f.full()
    no_mean = F.when(F.col("user_id") % 4 != 0, F.col("item_score_mean"))
    endless = F.when(F.col("item_id") % 5 == 1, F.lit(float("inf"))).otherwise(F.col("score"))
    return features.non_finite(*features.raw(full.withColumn("item_score_mean", no_mean).withColumn("score", endless)))


def _q_random_negatives(f: Fixture) -> DataFrame:
    return sampling.random_rows(sampling.classes(f.labelled())[1], 40).select("user_id", "item_id")


def _q_mixed_negatives(f: Fixture) -> DataFrame:
    return sampling.hard_and_random(sampling.classes(f.labelled())[1], 40, 25).select("user_id", "item_id")


def _q_stratified(f: Fixture) -> DataFrame:
    return sampling.stratified(f.base(), 100).select("user_id", "item_id")


def _q_random_split(f: Fixture) -> DataFrame:
    return sampling.random_split(f.base(), 0.2).select("user_id", "item_id", F.col("is_valid").cast("int").alias("is_valid"))


def _q_gbt(f: Fixture) -> DataFrame:
    built, names = features.build(f.full())
    built = work.written(built, "features")  # read by the sample and by the scoring
    labelled = metrics.attach_labels(built, f.labels)
    fitted = model.train(sampling.training_rows(labelled), names)
    return model.predict(fitted, built).select("user_id", "item_id", "probability_1")


def _q_incremental(f: Fixture) -> DataFrame:
    kept = incremental.history_of(incremental.partials(f.rows), TARGET, LOOKBACK)
    return history.features_of_daily(kept, "user")


def _metric(df: DataFrame) -> DataFrame:
    return _round(df, "precision", "recall", "f1")


_QUERIES: dict[str, Callable[[Fixture], DataFrame]] = {
    "profile_items": lambda f: _round(profile.items_profile(f.items), "missing_ratio"),
    "profile_behaviors": lambda f: _round(profile.log_profile(f.log), "missing_ratio"),
    "behavior_histogram": lambda f: profile.behavior_histogram(f.log),
    "target_ratio": lambda f: _round(profile.target_ratio(f.log, f.items), "target_ratio"),
    "item_ids": lambda f: logs.item_ids(f.items),
    "labels": lambda f: f.labels,
    "scores": lambda f: f.scores,
    **{f"{s}_features": (lambda f, s=s: history.features_of(f.past, s)) for s in history.SCOPES},
    "feature_cube": _q_feature_cube,
    "incremental_user_features": _q_incremental,
    "incremental_scores": lambda f: incremental.scores_of(incremental.history_of(incremental.partials(f.rows), TARGET, LOOKBACK)),
    "item_category_map": lambda f: history.item_category_map(f.rows),
    "active_users": lambda f: history.active_users(f.past),
    "ranked_topk": lambda f: select.per_user_topk(f.scores, K).select("user_id", "item_id", "units", F.col("rn").cast("long").alias("rn")),
    "min_score_topk": lambda f: select.per_user_topk(f.scores, K, min_score=2.0).select("user_id", "item_id", F.col("rn").cast("long").alias("rn")),
    "candidates_base": lambda f: _round(f.base().drop("units", "score"), *_STATS),
    "candidates_full": lambda f: f.full().select("user_id", "item_id", "rn", "item_category", *(f"{p}_{n}" for p in candidates.PREFIX.values() for n in ("last_hours_gap", *_COUNT_NAMES))),
    "fallback_stats": lambda f: _round(candidates.fallback_stats(select.per_user_topk(f.scores, K).select("user_id", "item_id", "score")).drop("score"), "user_score_max", "user_score_sum", "user_score_mean", "user_score_std", "item_score_max", "item_score_mean", "item_score_std"),
    "hybrid_score": lambda f: f.hybrid().select("user_id", "item_id", "hybrid"),
    "hybrid_neutral": lambda f: f.hybrid(features.Rules.neutral()).select("user_id", "item_id", "hybrid"),
    "blend": lambda f: _round(f.pseudo().select("user_id", "item_id", flows.model.blend(F.col("p"), 1.0 / F.col("rn"), 0.3).alias("blended")), "blended"),
    "global_topn": lambda f: select.global_topn(f.hybrid(), 100, "hybrid").select("user_id", "item_id", "hybrid"),
    "user_cap_topn": lambda f: select.global_topn(f.hybrid(), 100, "hybrid", user_cap=2, pool_n=200).select("user_id", "item_id", "hybrid"),
    "first_rows": lambda f: select.first_rows(f.base(), 50).select("user_id", "item_id", "rn"),
    "metrics_per_user": lambda f: _metric(metrics.per_user(f.scores, f.labels, K_GRID)),
    "metrics_global": lambda f: _metric(metrics.global_top(f.hybrid(), f.labels, N_GRID, "hybrid")),
    "metrics_global_capped": lambda f: _metric(metrics.global_top(f.hybrid(), f.labels, N_GRID, "hybrid", user_cap=2)),
    "best_topk": lambda f: _metric(metrics.best(metrics.per_user(f.scores, f.labels, K_GRID), "k")),
    "label_attach": lambda f: f.labelled().select("user_id", "item_id", "label"),
    "class_counts": lambda f: sampling.class_counts(f.labelled()),
    "hard_negatives": lambda f: select.hardest(sampling.classes(f.labelled())[1], 40).select("user_id", "item_id", "rn"),
    "strata_counts": lambda f: sampling.strata(f.base()).groupBy("stratum").agg(F.count("*").alias("n_rows")),
    "strata_quotas": lambda f: sampling.quotas(sampling.strata(f.base()), 100),
    "user_mod_split": _q_split,
    "submission_check": _q_submission,
    "strategy_choice": _q_strategy,
    "non_finite_check": _q_non_finite,
    "random_negatives": _q_random_negatives,
    "mixed_negatives": _q_mixed_negatives,
    "stratified_rows": _q_stratified,
    "random_split": _q_random_split,
    "promotion_gate": _q_gate,
    "sample_counts": _q_sample_counts,
    "bounded_sample_counts": _q_bounded_counts,
    "gbt_scores": _q_gbt,
}

_FEATURE_QUERIES = {
    "features_base": (False, lambda n: n in _BASE),
    "features_ratio": (False, _is_ratio),
    "features_share": (False, _is_share),
    "features_enhanced": (True, lambda n: n in _ENHANCED),
    "features_all": (True, lambda n: True),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {n: (lambda spark, sf_dir, q=q: q(Fixture(spark, sf_dir))) for n, q in _QUERIES.items()}
    return out | {n: _feature_query(*x) for n, x in _FEATURE_QUERIES.items()}


# -- the SQL -------------------------------------------------------------------


def _measures(prefix: str = "") -> str:
    counts = ", ".join(f"CAST(sum(CASE WHEN behavior_type = {b} AND days <= {w} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, b, w in COUNTS)
    return f"CAST(min(gap) AS INTEGER) AS last_hours_gap, {counts}"


def _joined(scope: str) -> str:
    p = candidates.PREFIX[scope]
    gap = f"coalesce({p}.last_hours_gap, 99999) AS {p}_last_hours_gap"
    return ", ".join([gap, *(f"coalesce({p}.{n}, 0) AS {p}_{n}" for n in _COUNT_NAMES)])


_UNITS = "CAST(sum(CAST(floor(CASE behavior_type WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 3.0 WHEN 3 THEN 6.0 ELSE 10.0 END * pow(0.85::DOUBLE, days) * 1e9 + 0.5) AS BIGINT)) AS BIGINT)"


#: The order of random picks with seed 42.
_PAIR_HASH = "('0x' || substr(md5(concat_ws(':', user_id, item_id, '42')), 1, 15))::BIGINT"

#: H1 to H5 with the default weights and a threshold of 5 clicks.
_HYBRID = """p
  * CASE WHEN p_b2_1d + p_b3_1d + p_b4_1d > 0 THEN 1.25::DOUBLE ELSE 1 END
  * (1 + 0.5::DOUBLE * least((p_b1_1d + 3 * p_b2_1d + 6 * p_b3_1d + 10 * p_b4_1d)::DOUBLE / (u_b1_1d + 3 * u_b2_1d + 6 * u_b3_1d + 10 * u_b4_1d + 1), 1.5))
  * (1 + 0.25::DOUBLE * least(i_b4_14d::DOUBLE / (i_b1_14d + 1), 1))
  * (1 + 0.1::DOUBLE * least(24 * (1::DOUBLE / (least(p_last_hours_gap, 99999) + 1)), 1))
  * CASE WHEN i_b1_14d >= 5 AND i_b4_14d = 0 THEN 0.05::DOUBLE ELSE 1 END"""


def _feature_sql(enhanced: bool) -> dict[str, str]:
    """X1 to X25 by name."""
    sql = {
        "score": "score", "rn": "rn", "log_score": "ln(1 + score)", "rank_inv": "1::DOUBLE / rn", "rank_pct": "rn / (user_candidate_count + 1e-6::DOUBLE)",
        "score_div_user_max": "score / (user_score_max + 1e-6::DOUBLE)", "score_div_user_sum": "score / (user_score_sum + 1e-6::DOUBLE)",
        "score_minus_user_mean": "score - user_score_mean", "score_minus_item_mean": "score - item_score_mean",
        "user_candidate_count_log": "ln(1::DOUBLE + user_candidate_count)", "item_candidate_user_count_log": "ln(1::DOUBLE + item_candidate_user_count)",
        "user_score_std": "sqrt(greatest(user_score_sq_sum / (user_candidate_count + 1e-6::DOUBLE) - user_score_mean ** 2, 0))",
        "item_score_std": "sqrt(greatest(item_score_sq_sum / (item_candidate_user_count + 1e-6::DOUBLE) - item_score_mean ** 2, 0))",
        "user_score_mean": "user_score_mean", "user_candidate_count": "user_candidate_count",
        "item_score_mean": "item_score_mean", "item_candidate_user_count": "item_candidate_user_count", "item_category": "coalesce(item_category, -1)",
        "p_buy_share_user_14d": "p_b4_14d::DOUBLE / (u_b4_14d + 1)", "p_buy_share_item_14d": "p_b4_14d::DOUBLE / (i_b4_14d + 1)",
        "p_buy_share_cat_14d": "p_b4_14d::DOUBLE / (c_b4_14d + 1)", "p_buy_share_uc_14d": "p_b4_14d::DOUBLE / (uc_b4_14d + 1)",
        "p_cart_share_user_14d": "p_b3_14d::DOUBLE / (u_b3_14d + 1)", "p_cart_share_item_14d": "p_b3_14d::DOUBLE / (i_b3_14d + 1)",
        "p_cart_share_cat_14d": "p_b3_14d::DOUBLE / (c_b3_14d + 1)", "p_cart_share_uc_14d": "p_b3_14d::DOUBLE / (uc_b3_14d + 1)",
    }
    engaged = "({0}_b1_{1}d + 3 * {0}_b2_{1}d + 6 * {0}_b3_{1}d + 10 * {0}_b4_{1}d)::DOUBLE"
    for scope in ("p", "u", "i", "c", "uc"):
        b1, b2, b3, b4 = (f"{scope}_b{k}_14d" for k in (1, 2, 3, 4))
        sql |= {f"{scope}_{n}": f"{scope}_{n}" for n in _COUNT_NAMES}
        sql |= {
            f"{scope}_last_hours_gap": f"greatest(0, least({scope}_last_hours_gap, 99999))",
            f"{scope}_last_hours_gap_inv": f"1::DOUBLE / (greatest(0, least({scope}_last_hours_gap, 99999)) + 1)",
            f"{scope}_buy_click_ratio_14d": f"{b4}::DOUBLE / ({b1} + 1)", f"{scope}_buy_fav_ratio_14d": f"{b4}::DOUBLE / ({b2} + 1)",
            f"{scope}_buy_cart_ratio_14d": f"{b4}::DOUBLE / ({b3} + 1)",
            f"{scope}_engage_14d": engaged.format(scope, 14), f"{scope}_engage_1d": engaged.format(scope, 1),
        }
        if enhanced and scope not in ("u", "i"):
            sql[f"{scope}_buy_click_ratio_14d_s"] = f"({b4} + 1)::DOUBLE / ({b1} + 2)"
            sql[f"{scope}_buy_cart_ratio_14d_s"] = f"({b4} + 1)::DOUBLE / ({b3} + 2)"
    if enhanced:
        day = {x: engaged.format(x, 1) for x in ("p", "u", "uc")}
        sql |= {
            "recency_intent_cross": f"least(24 * (1::DOUBLE / (least(p_last_hours_gap, 99999) + 1)), 1) * ln(1 + {day['p']})",
            "pair_share_in_user_1d": f"{day['p']} / ({day['u']} + 1)", "pair_share_in_uc_1d": f"{day['p']} / ({day['uc']} + 1)",
            "strong_intent_flag": "CASE WHEN p_b2_1d + p_b3_1d > 0 AND p_b4_1d = 0 THEN 1 ELSE 0 END",
            "zombie_item_flag": "CASE WHEN i_b1_14d + i_b2_14d + i_b3_14d >= 60 AND i_b4_14d = 0 THEN 1 ELSE 0 END",
        }
    return sql


def _with() -> str:
    scopes = ",\n".join(f"{s}_features AS (SELECT {', '.join(k)}, {_measures()} FROM past GROUP BY {', '.join(k)})" for s, k in history.SCOPES.items())
    return f"""WITH log AS (
  SELECT event_id, user_id, CAST(props->>'$.k' AS BIGINT) AS item_id,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS behavior_type,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE 'g' END AS user_geohash, strftime(ts, '%Y-%m-%d %H') AS time,
    CAST(CAST(props->>'$.k' AS BIGINT) % 10 AS INTEGER) AS item_category
  FROM events WHERE event_type IN ('view', 'click', 'signup', 'purchase')),
items AS (SELECT DISTINCT item_id, CAST(NULL AS VARCHAR) AS item_geohash, item_category FROM log WHERE item_id % 5 <> 0),
rows_p AS (SELECT * FROM log WHERE item_id IN (SELECT item_id FROM items)),
past AS (
  SELECT user_id, item_id, behavior_type, item_category, days, (days - 1) * 24 + 24 - hour AS gap
  FROM (SELECT *, date_diff('day', CAST(time[1:10] AS DATE), DATE '{TARGET}') AS days, CAST(right(time, 2) AS INTEGER) AS hour FROM rows_p)
  WHERE days BETWEEN 1 AND {LOOKBACK}),
buys AS (SELECT DISTINCT user_id, item_id FROM rows_p WHERE time[1:10] = '{TARGET}' AND behavior_type = 4),
scores AS (SELECT *, units / 1e9::DOUBLE AS score FROM (SELECT user_id, item_id, {_UNITS} AS units FROM past GROUP BY user_id, item_id)),
{scopes},
item_category_map AS (SELECT item_id, first(item_category ORDER BY time, item_category) AS item_category FROM rows_p GROUP BY item_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY units DESC, item_id) AS rn FROM scores),
base AS (
  SELECT *, max(score) OVER u AS user_score_max, sum(units) OVER u / 1e9::DOUBLE AS user_score_sum,
    sum(units) OVER u / CAST(count(*) OVER u AS DOUBLE) / 1e9::DOUBLE AS user_score_mean, sum(score * score) OVER u AS user_score_sq_sum,
    count(*) OVER u AS user_candidate_count, max(score) OVER i AS item_score_max,
    sum(units) OVER i / CAST(count(*) OVER i AS DOUBLE) / 1e9::DOUBLE AS item_score_mean, sum(score * score) OVER i AS item_score_sq_sum,
    count(*) OVER i AS item_candidate_user_count
  FROM ranked WHERE rn <= {K} WINDOW u AS (PARTITION BY user_id), i AS (PARTITION BY item_id)),
full_c AS (
  SELECT base.*, {', '.join(_joined(s) for s in history.SCOPES)}, coalesce(m.item_category, -1) AS item_category
  FROM base LEFT JOIN pair_features p USING (user_id, item_id) LEFT JOIN user_features u USING (user_id)
  LEFT JOIN item_features i USING (item_id) LEFT JOIN item_category_map m USING (item_id)
  LEFT JOIN category_features c ON c.item_category = m.item_category
  LEFT JOIN user_category_features uc ON uc.user_id = base.user_id AND uc.item_category = m.item_category),
pseudo AS (SELECT *, score / (user_score_max + 1e-6::DOUBLE) AS p FROM full_c),
hybrids AS (SELECT *, round({_HYBRID}, 6) AS hybrid FROM pseudo),
labelled AS (SELECT f.*, CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS label FROM full_c f LEFT JOIN buys b USING (user_id, item_id)),
placed AS (SELECT *, row_number() OVER (ORDER BY hybrid DESC, user_id, item_id) AS place FROM hybrids),
strata AS (
  SELECT *, concat_ws('_', CASE WHEN rn <= 5 THEN 'r5' WHEN rn <= 10 THEN 'r10' WHEN rn <= 20 THEN 'r20' WHEN rn <= 50 THEN 'r50' ELSE 'rest' END,
    CASE WHEN pct <= 0.25 THEN 'q1' WHEN pct <= 0.5 THEN 'q2' WHEN pct <= 0.75 THEN 'q3' ELSE 'q4' END) AS stratum
  FROM (SELECT *, row_number() OVER (ORDER BY score, user_id, item_id) / CAST(count(*) OVER () AS DOUBLE) AS pct FROM base))
"""


def _evaluated(key: str, counts: str) -> str:
    """Ratios over ``counts`` (key, predictions, hits)."""
    return f"""SELECT {key}, predictions, labels, hits, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM (
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1 FROM (
SELECT *, CASE WHEN predictions > 0 THEN hits / CAST(predictions AS DOUBLE) ELSE 0.0 END AS precision,
  CASE WHEN labels > 0 THEN hits / CAST(labels AS DOUBLE) ELSE 0.0 END AS recall
FROM (SELECT {key}, predictions, CAST(hits AS BIGINT) AS hits, (SELECT count(*) FROM buys) AS labels FROM ({counts}))))"""


def _per_user_counts(source: str, grid: list[int], score: str) -> str:
    cut = f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {score} DESC, item_id) AS r FROM {source}"
    return f"""SELECT CAST(k AS BIGINT) AS k, count(x.user_id) AS predictions, count(b.user_id) AS hits
FROM (SELECT unnest({grid}) AS k) LEFT JOIN ({cut}) x ON x.r <= k LEFT JOIN buys b ON b.user_id = x.user_id AND b.item_id = x.item_id GROUP BY k"""


def _global_counts(grid: list[int], cap: int = 0) -> str:
    pool = f"SELECT * FROM placed WHERE place <= {max(grid)}"
    if cap:
        pool = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY place) AS of_user FROM ({pool})) WHERE of_user <= {cap}"
    return f"""SELECT CAST(n AS BIGINT) AS n, count(x.user_id) AS predictions, count(b.user_id) AS hits
FROM (SELECT unnest({grid}) AS n) LEFT JOIN (SELECT *, row_number() OVER (ORDER BY place) AS r FROM ({pool})) x ON x.r <= n
LEFT JOIN buys b ON b.user_id = x.user_id AND b.item_id = x.item_id GROUP BY n"""


def _best(evaluated: str, key: str) -> str:
    return f"SELECT * FROM ({evaluated}) ORDER BY f1 DESC, {key} LIMIT 1"


def _features_sql(enhanced: bool, pick: Callable[[str], bool]) -> str:
    chosen = ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS f_{n}" for n, e in sorted(_feature_sql(enhanced).items()) if pick(n))
    return f"SELECT user_id, item_id, {chosen} FROM full_c"


def oracle_sql() -> dict[str, str]:
    counts = ", ".join(_COUNT_NAMES)
    cube = " UNION ALL ".join(
        f"SELECT '{s}' AS scope, {', '.join(c if c in k else f'-1 AS {c}' for c in ('user_id', 'item_id', 'item_category'))}, last_hours_gap, {counts} FROM {s}_features"
        for s, k in history.SCOPES.items()
    )
    stats = ", ".join(f"round({n}, 6) AS {n}" for n in _STATS)
    every = ", ".join(f"{p}_{n}" for p in candidates.PREFIX.values() for n in ("last_hours_gap", *_COUNT_NAMES))
    neutral = "SELECT user_id, item_id, round(p, 6) AS hybrid FROM pseudo"
    quota = """SELECT stratum, n_rows, CAST(least(n_rows, whole + CASE WHEN row_number() OVER (ORDER BY round(exact - whole, 9) DESC, stratum) <= least(100, total) - taken THEN 1 ELSE 0 END) AS BIGINT) AS quota
FROM (SELECT *, CAST(floor(exact) AS BIGINT) AS whole, sum(CAST(floor(exact) AS BIGINT)) OVER () AS taken FROM (
  SELECT *, least(100, total) * n_rows / CAST(total AS DOUBLE) AS exact FROM (
    SELECT stratum, count(*) AS n_rows, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM strata GROUP BY stratum)))"""
    gates = " ".join(f"WHEN f1 >= {x} THEN '{n}'" for x, n in flows.GATES)
    exact_f1 = _evaluated("n", _global_counts(N_GRID)).replace("round(f1, 6) AS f1", "f1")
    strategy = f"""SELECT strategy, cut, round(f1, 6) AS f1 FROM (
SELECT 'per_user' AS strategy, k AS cut, f1 FROM ({_best(_evaluated('k', _per_user_counts('hybrids', [5, 10], 'hybrid')).replace('round(f1, 6) AS f1', 'f1'), 'k')})
UNION ALL SELECT 'global', n, f1 FROM ({_best(exact_f1, 'n')})) ORDER BY f1 DESC, strategy DESC LIMIT 1"""
    capped = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY place) AS of_user FROM placed WHERE place <= 200"
    fallback = """SELECT user_id, item_id, round(max(score) OVER u, 6) AS user_score_max, round(sum(score) OVER u, 6) AS user_score_sum, round(avg(score) OVER u, 6) AS user_score_mean,
round(coalesce(stddev_samp(score) OVER u, 0), 6) AS user_score_std, count(*) OVER u AS user_candidate_count, round(max(score) OVER i, 6) AS item_score_max,
round(avg(score) OVER i, 6) AS item_score_mean, round(coalesce(stddev_samp(score) OVER i, 0), 6) AS item_score_std, count(*) OVER i AS item_candidate_user_count
FROM base WINDOW u AS (PARTITION BY user_id), i AS (PARTITION BY item_id)"""
    wrong = " + ".join(f"sum(CASE WHEN {e} IS NULL OR isnan(CAST({e} AS DOUBLE)) OR isinf(CAST({e} AS DOUBLE)) THEN 1 ELSE 0 END)" for e in _feature_sql(True).values())
    hardest = "SELECT *, row_number() OVER (ORDER BY rn, score DESC, user_id) AS place FROM labelled WHERE label = 0"
    profile_ratio = "CAST(sum(CASE WHEN {c} IS NULL OR {c} = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_missing_geohash, round(avg(CASE WHEN {c} IS NULL OR {c} = '' THEN 1.0 ELSE 0.0 END), 6) AS missing_ratio"
    sql = {
        "profile_items": f"SELECT count(*) AS n_rows, count(DISTINCT item_id) AS n_items, count(DISTINCT item_category) AS n_categories, {profile_ratio.format(c='item_geohash')} FROM items",
        "profile_behaviors": f"SELECT count(*) AS n_rows, {profile_ratio.format(c='user_geohash')}, min(time[1:10]) AS first_day, max(time[1:10]) AS last_day, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, count(DISTINCT item_category) AS n_categories FROM log",
        "behavior_histogram": "SELECT behavior_type, count(*) AS n_rows FROM log GROUP BY behavior_type",
        "target_ratio": "SELECT count(*) AS n_rows, CAST(sum(CASE WHEN item_id IN (SELECT item_id FROM items) THEN 1 ELSE 0 END) AS BIGINT) AS n_target, round(avg(CASE WHEN item_id IN (SELECT item_id FROM items) THEN 1.0 ELSE 0.0 END), 6) AS target_ratio FROM log",
        "item_ids": "SELECT DISTINCT item_id FROM items",
        "labels": "SELECT * FROM buys",
        "scores": "SELECT * FROM scores",
        **{f"{s}_features": f"SELECT * FROM {s}_features" for s in history.SCOPES},
        "feature_cube": cube,
        "incremental_user_features": "SELECT * FROM user_features",
        "incremental_scores": "SELECT * FROM scores",
        "item_category_map": "SELECT * FROM item_category_map",
        "active_users": "SELECT DISTINCT user_id FROM past",
        "ranked_topk": f"SELECT user_id, item_id, units, rn FROM ranked WHERE rn <= {K}",
        "min_score_topk": f"SELECT user_id, item_id, rn FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY units DESC, item_id) AS rn FROM scores WHERE score >= 2.0) WHERE rn <= {K}",
        "candidates_base": f"SELECT user_id, item_id, rn, user_candidate_count, item_candidate_user_count, {stats} FROM base",
        "candidates_full": f"SELECT user_id, item_id, rn, item_category, {every} FROM full_c",
        "fallback_stats": fallback,
        "hybrid_score": "SELECT user_id, item_id, hybrid FROM hybrids",
        "hybrid_neutral": neutral,
        "blend": "SELECT user_id, item_id, round(0.7::DOUBLE * p + 0.3::DOUBLE * (1.0::DOUBLE / rn), 6) AS blended FROM pseudo",
        "global_topn": "SELECT user_id, item_id, hybrid FROM placed WHERE place <= 100",
        "user_cap_topn": f"SELECT user_id, item_id, hybrid FROM ({capped}) WHERE of_user <= 2 ORDER BY place LIMIT 100",
        "first_rows": "SELECT user_id, item_id, rn FROM base ORDER BY user_id, rn LIMIT 50",
        "metrics_per_user": _evaluated("k", _per_user_counts("scores", K_GRID, "units")),
        "metrics_global": _evaluated("n", _global_counts(N_GRID)),
        "metrics_global_capped": _evaluated("n", _global_counts(N_GRID, 2)),
        "best_topk": _best(_evaluated("k", _per_user_counts("scores", K_GRID, "units")), "k"),
        "label_attach": "SELECT user_id, item_id, label FROM labelled",
        "class_counts": "SELECT label, count(*) AS n_rows FROM labelled GROUP BY label",
        "hard_negatives": "SELECT user_id, item_id, rn FROM labelled WHERE label = 0 ORDER BY rn, score DESC, user_id LIMIT 40",
        "strata_counts": "SELECT stratum, count(*) AS n_rows FROM strata GROUP BY stratum",
        "strata_quotas": quota,
        "user_mod_split": "SELECT CASE WHEN user_id % 5 = 0 THEN 'valid' ELSE 'train' END AS part, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM base GROUP BY 1",
        "submission_check": f"SELECT count(*) AS n_rows, count(DISTINCT (user_id, item_id)) AS n_pairs, count(DISTINCT user_id) AS n_users FROM ranked WHERE rn <= {K}",
        "strategy_choice": strategy,
        "non_finite_check": f"SELECT CAST({wrong} AS BIGINT) AS n_non_finite FROM (SELECT * REPLACE (CASE WHEN user_id % 4 <> 0 THEN item_score_mean END AS item_score_mean, CASE WHEN item_id % 5 = 1 THEN 'inf'::DOUBLE ELSE score END AS score) FROM full_c)",
        "random_negatives": f"SELECT user_id, item_id FROM labelled WHERE label = 0 ORDER BY {_PAIR_HASH}, user_id, item_id LIMIT 40",
        "mixed_negatives": f"SELECT user_id, item_id FROM ({hardest}) WHERE place <= 25 UNION ALL SELECT * FROM (SELECT user_id, item_id FROM ({hardest}) WHERE place > 25 ORDER BY {_PAIR_HASH}, user_id, item_id LIMIT 15)",
        "stratified_rows": f"SELECT user_id, item_id FROM (SELECT s.*, greatest(row_number() OVER (PARTITION BY stratum ORDER BY {_PAIR_HASH}, user_id, item_id) - quota, 0) AS over FROM strata s JOIN ({quota}) q USING (stratum)) ORDER BY over, {_PAIR_HASH}, user_id, item_id LIMIT 100",
        "random_split": f"SELECT user_id, item_id, CASE WHEN {_PAIR_HASH} % 10000 < 2000 THEN 1 ELSE 0 END AS is_valid FROM base",
        "sample_counts": "SELECT label, CASE label WHEN 1 THEN count(*) ELSE least(count(*), 3 * (SELECT count(*) FROM labelled WHERE label = 1)) END AS n_rows FROM labelled GROUP BY label",
        "bounded_sample_counts": "SELECT label, least(count(*), CASE label WHEN 1 THEN 10 ELSE 100 END) AS n_rows FROM labelled GROUP BY label",
        "promotion_gate": f"SELECT n, round(f1, 6) AS f1, CASE {gates} ELSE 'continue' END AS gate FROM ({exact_f1})",
    }
    sql |= {n: _features_sql(*x) for n, x in _FEATURE_QUERIES.items()}
    return {n: _with() + s for n, s in sql.items()}
