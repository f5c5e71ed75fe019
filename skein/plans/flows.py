"""End-to-end flows: baseline, rerank, global fusion search.

Every step is a DataFrame function, so the submission day runs the same plan as
the evaluation day. What several steps read is written once as Parquet
(:class:`Tables`), which also cuts lineage.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JError
from pyspark import InheritableThread
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import candidates, features, history, metrics, model, sampling, select
from skein.operators.features import Rules
from skein.schema import WEIGHTS
from skein.sources import work


@dataclass
class Tables:
    """The tables of one target day."""

    scores: DataFrame
    labels: DataFrame
    features: dict[str, DataFrame]
    category_map: DataFrame
    active_users: DataFrame

    @staticmethod
    def build(log: DataFrame, items: DataFrame, target: str, lookback: int = 14, decay: float = 0.85, weights=WEIGHTS, path: str | None = None) -> Tables:
        """With ``path`` each table is written below it and read again.

        The history is read once, into daily partials from which scores and all scopes come.
        """
        rows = history.of_items(log, items)
        past = work.written(history.daily(history.history(rows, target, lookback)), "daily")
        made = {
            "scores": history.scores_of_daily(past, decay, weights), "labels": history.labels(rows, target), "active_users": history.active_users(past),
            "item_category_map": history.item_category_map(rows), **{f"{s}_features": history.features_of_daily(past, s) for s in history.SCOPES},
        }
        if path:
            for name, df in made.items():
                df.write.mode("overwrite").parquet(f"{path}/{target}/{name}")
            made = Tables.read(log.sparkSession, f"{path}/{target}", list(made))
        by_scope = {s: made[f"{s}_features"] for s in history.SCOPES}
        return Tables(made["scores"], made["labels"], by_scope, made["item_category_map"], made["active_users"])

    @staticmethod
    def read(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
        return {n: spark.read.parquet(f"{path}/{n}") for n in names}

    def candidates(self, k: int) -> DataFrame:
        return candidates.full(self.scores, k, self.features, self.category_map)


def _records(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]  # one row a grid value


def baseline(tables: Tables, grid: list[int], k: int, min_score: float = 0.0) -> dict:
    """Entry A: metrics for each k, the best k, and the ranked pairs of the chosen one."""
    pool = tables.scores.where(F.col("score") >= min_score)
    rows = _records(metrics.per_user(pool, tables.labels, sorted({*grid, k})).orderBy("k"))
    return {"metrics": rows, "best": best_of(rows, "k"), "predictions": select.per_user_topk(pool, k)}


def best_of(rows: list[dict], key: str) -> dict:
    """A17 on the driver: the highest F1, the smallest value among equals."""
    return max(sorted(rows, key=lambda r: r[key]), key=lambda r: r["f1"])


@dataclass
class Reranked:
    model: object
    scored: DataFrame
    metrics: list[dict]
    best: dict
    protocol: str = "global_topn"
    seconds: dict[str, float] = field(default_factory=dict)


def rerank(
    tables: Tables, k: int = 50, grid: list[int] = (1000,), params: model.ModelParams = model.ModelParams(), neg_pos_ratio: int = 30,
    mode: str = "mixed", enhanced: bool = True, protocol: str = "global_topn", bounded: bool = False,
) -> Reranked:
    """Entry B: candidates, features, sample, training, scoring, evaluation."""
    begun = time.monotonic()
    cand = tables.candidates(k)
    built, names = features.build(cand, enhanced)
    built = work.written(built, "features")  # read by the sample and by the scoring
    labelled = metrics.attach_labels(built, tables.labels)
    sample = sampling.bounded_rows(labelled) if bounded else sampling.training_rows(labelled, neg_pos_ratio, mode, params.seed)
    fitted = model.train(sample, names, params)
    trained = time.monotonic()
    scored = model.predict(fitted, built)
    if protocol == "global_topn":
        rows, key = _records(metrics.global_top(scored, tables.labels, list(grid), "probability_1").orderBy("n")), "n"
    else:
        rows, key = _records(metrics.per_user(scored, tables.labels, list(grid), "probability_1").orderBy("k")), "k"
    return Reranked(fitted, scored, rows, best_of(rows, key), protocol, {"train": trained - begun, "evaluate": time.monotonic() - trained})


def fused(tables: Tables, k: int, fitted, rules: Rules = Rules(), second=None, share: float = 0.0) -> DataFrame:
    """Candidates of one K with the model's probability and the hybrid score; the model's own feature list is used."""
    cand = tables.candidates(k)
    built, _ = features.build(cand, True)
    scored = model.predict(fitted, built) if second is None else model.predict_two(fitted, second, built, share)
    keep = scored.select("user_id", "item_id", "probability_1")
    return features.hybrid(cand.join(keep, ["user_id", "item_id"]), "probability_1", rules)


def fusion_search(
    tables: Tables, fitted, k_grid: list[int], n_grid: list[int], rules: Rules = Rules(), user_cap: int = 0, second=None, share: float = 0.0
) -> dict:
    """Entry C, M14: (K, N) by F1; among equals the first K, then the smallest N."""
    trials = []
    for k in k_grid:
        scored = fused(tables, k, fitted, rules, second, share)
        trials += [r | {"k": k} for r in _records(metrics.global_top(scored, tables.labels, n_grid, "hybrid", user_cap).orderBy("n"))]
    best = trials[0]
    for t in trials[1:]:
        if t["f1"] > best["f1"]:
            best = t
    return {"trials": trials, "best": best, "metric_protocol": "global_topn"}


def submit(tables: Tables, fitted, best: dict, rules: Rules = Rules(), user_cap: int = 0, second=None, share: float = 0.0) -> DataFrame:
    """The best K and N, and the same one or two models, on another day's tables."""
    return select.global_topn(fused(tables, best["k"], fitted, rules, second, share), best["n"], "hybrid", user_cap).select("user_id", "item_id")


def choose_strategy(per_user: dict, global_: dict, forced: str = "auto") -> str:
    """per_user among equals."""
    if forced != "auto":
        return forced
    return "global" if global_["f1"] > per_user["f1"] else "per_user"


def override(given: int | None, found: int) -> int:
    """Q15: ``None`` means that nothing was given."""
    if given is None:
        return found
    if given <= 0:
        raise ValueError("an override is a positive number")
    return given


#: The order of the coordinate search.
RULE_ORDER = ("zombie_penalty", "strong_bonus", "loyalty_weight", "cvr_weight", "recency_weight")


def coordinate_search(score: Callable[[Rules], float], grids: dict[str, list[float]], start: Rules = Rules()) -> tuple[Rules, float, list]:
    """O1: one parameter after the other; a strictly better value is taken at once."""
    best, value, probes = start, score(start), []
    for name in RULE_ORDER:
        for x in grids.get(name, ()):
            if x == getattr(best, name):
                continue
            rules = replace(best, **{name: x})
            got = score(rules)
            probes.append((name, x, got))
            if got > value:
                best, value = rules, got
    return best, value, probes


def patient_scan(score: Callable[[float], float], values: list[float], least: int = 4, patience: int = 3, goal: float | None = None):
    """O2, O3: stops after ``patience`` probes without gain once ``least`` are made, or at the goal."""
    best, value, idle, probes = None, float("-inf"), 0, []
    for x in values:
        got = score(x)
        probes.append((x, got))
        best, value, idle = (x, got, 0) if got > value else (best, value, idle + 1)
        if goal is not None and value >= goal or len(probes) >= least and idle >= patience:
            break
    return best, value, probes


#: Promotion thresholds, and the least F1 for a submission.
GATES = ((0.088, "sprint"), (0.080, "main"), (0.078, "tune"))
SUBMIT_MIN_F1 = 0.082


def gate(f1: float) -> str:
    """O5."""
    return next((name for least, name in GATES if f1 >= least), "continue")


def gate_column(f1):
    c = F
    for least, name in GATES:
        c = c.when(f1 >= least, F.lit(name))
    return c.otherwise(F.lit("continue"))


def may_submit(f1: float, least: float = SUBMIT_MIN_F1) -> bool:
    """O10."""
    return f1 >= least


def rank_models(runs: dict[str, float]) -> list[str]:
    """By falling F1 (ties by name): the best and its backups."""
    return sorted(runs, key=lambda n: (-runs[n], n))


def require_protocol(summary: dict, wanted: str = "global_topn") -> None:
    """O7."""
    if summary.get("metric_protocol") != wanted:
        raise ValueError(f"metric protocol {summary.get('metric_protocol')!r}, not {wanted!r}")


def with_fallbacks(attempts: list[Callable[[], object]], hours: float = 4.0):
    """The first attempt that works within the time cap (fewer negatives, plainer features, ...).

    An attempt that runs over what is left of the cap has its Spark jobs cancelled. What fails an attempt: wrong
    values, arithmetic, and whatever Spark raises.
    """
    ends, error = time.monotonic() + 3600 * hours, None
    for k, attempt in enumerate(attempts):
        left = ends - time.monotonic()
        if left <= 0:
            break
        try:
            return _within(attempt, left, f"attempt-{k}-{uuid.uuid4().hex}")
        except (ValueError, ArithmeticError, TimeoutError, PySparkException, Py4JError) as e:
            error = e
    raise RuntimeError("no attempt worked") from error


def _within(attempt: Callable[[], object], seconds: float, group: str):
    """``attempt`` in a thread whose Spark jobs are cancelled after so many seconds."""
    spark, out = SparkSession.getActiveSession(), {}

    def run() -> None:
        try:
            if spark:
                spark.sparkContext.setJobGroup(group, group, True)
            out["value"] = attempt()
        except BaseException as e:  # raised again by the caller's thread
            out["error"] = e

    thread = InheritableThread(target=run, daemon=True) if spark is None else InheritableThread(target=run, daemon=True, session=spark)
    thread.start()
    thread.join(seconds)
    if thread.is_alive():
        if spark:
            spark.sparkContext.cancelJobGroup(group)
        raise TimeoutError(f"over {seconds:.0f} s")
    if "error" in out:
        raise out["error"]
    return out["value"]


def fallback_attempts(tables: Tables, k: int, grid: list[int], params: model.ModelParams, ratio: int = 30) -> list[Callable[[], Reranked]]:
    """As asked, then without enhanced features, then with half and a quarter of the negatives besides."""
    plans = ((True, ratio), (False, ratio), (False, max(1, ratio // 2)), (False, max(1, ratio // 4)))
    return [lambda e=e, n=n: rerank(tables, k, grid, params, n, enhanced=e) for e, n in plans]


#: Model presets.
PRESETS = {
    "P1": model.ModelParams(num_boost_round=400, learning_rate=0.05, num_leaves=63, min_data_in_leaf=50),
    "P2": model.ModelParams(num_boost_round=600, learning_rate=0.03, num_leaves=127, min_data_in_leaf=100),
    "S1": model.ModelParams(num_boost_round=1200, learning_rate=0.03, num_leaves=255, min_data_in_leaf=120, valid_ratio=0.1),
    "S2": model.ModelParams(num_boost_round=1600, learning_rate=0.025, num_leaves=383, min_data_in_leaf=120, valid_ratio=0.1),
    "S3": model.ModelParams(num_boost_round=2200, learning_rate=0.02, num_leaves=511, min_data_in_leaf=150, valid_ratio=0.1),
    "S4": model.ModelParams(num_boost_round=1600, learning_rate=0.025, num_leaves=383, min_data_in_leaf=120, valid_ratio=0.1),
}
#: Candidates a user, most negatives, and the share of hard ones, of the presets that fix them.
PRESET_ROWS = {
    name: {"candidate_topk": k, "max_negatives": 300_000, "hard_share": 0.0} for name, k in {"S1": 50, "S2": 50, "S3": 50, "S4": 60}.items()
}


def staged(tables: Tables, quick: model.ModelParams, final: model.ModelParams, k_grid: list[int], n_grid: list[int], rules: Rules = Rules.neutral()) -> dict:
    """A quick fusion, training anew, the final fusion, and the better of the two."""
    runs = {}
    for name, params in (("quick", quick), ("final", final)):
        fitted = rerank(tables, max(k_grid), n_grid, params).model
        runs[name] = fusion_search(tables, fitted, k_grid, n_grid, rules)["best"]
    return {"runs": runs, "order": rank_models({n: r["f1"] for n, r in runs.items()}), "gate": gate(max(r["f1"] for r in runs.values()))}
