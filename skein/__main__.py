"""``python -m skein baseline|rerank|fusion``: the three flows over a folder of behaviour logs.

Each reads the log files, evaluates on ``--eval-date``, writes the pairs for
``--predict-date`` and a JSON summary below ``--output-dir``. Paths may be on any
file system that Spark reads.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from skein.functions.scalars import int_grid
from skein.operators.features import Rules
from skein.operators.model import ModelParams
from skein.plans import flows
from skein.schema import CART, CLICK, FAVOURITE, PURCHASE
from skein.sources import logs, sinks

MODEL = ("num_boost_round", "learning_rate", "num_leaves", "min_data_in_leaf", "feature_fraction", "bagging_fraction", "valid_ratio", "early_stopping_gain", "seed")
RULES = ("zombie_click_threshold", "zombie_penalty", "strong_bonus", "loyalty_weight", "cvr_weight", "recency_weight")


def parser() -> argparse.ArgumentParser:
    """Flags of the three flows; defaults are those of the functions behind them."""
    top = argparse.ArgumentParser(prog="skein")
    subs = top.add_subparsers(dest="flow", required=True)
    for name in ("baseline", "rerank", "fusion"):
        p = subs.add_parser(name)
        p.add_argument("--data-dir", required=True)
        p.add_argument("--output-dir", required=True)
        p.add_argument("--log-files", nargs="+", help="file names in the data folder")
        p.add_argument("--items-file", default="items.txt")
        p.add_argument("--eval-date", default="2014-12-18")
        p.add_argument("--predict-date", default="2014-12-19")
        p.add_argument("--lookback-days", type=int, default=14)
        p.add_argument("--decay", type=float, default=0.85)
        for flag, value in (("click", 1.0), ("favorite", 3.0), ("cart", 6.0), ("buy", 10.0)):
            p.add_argument(f"--{flag}-weight", type=float, default=value)
        p.add_argument("--max-rows-per-file", type=int)
        p.add_argument("--skip-submit", action="store_true")
        if name == "baseline":
            p.add_argument("--topk", type=int)
            p.add_argument("--topk-grid", type=int_grid, default=[10, 20, 30, 50])
            p.add_argument("--min-score", type=float, default=0.0)
            continue
        p.add_argument("--candidate-topk", type=int, default=50)
        p.add_argument("--global-topn-grid", type=int_grid, default=[20_000, 40_000, 60_000, 80_000])
        p.add_argument("--global-topn", type=int, help="in place of the best of the grid")
        p.add_argument("--global-user-cap", type=int, default=0)
        p.add_argument("--preset", choices=sorted(flows.PRESETS))
        for field in MODEL:
            p.add_argument(f"--{field.replace('_', '-')}", type=type(getattr(ModelParams(), field)))
        p.add_argument("--neg-pos-ratio", type=int, default=30)
        p.add_argument("--negative-mode", choices=("random", "hard", "mixed"), default="mixed")
        p.add_argument("--no-enhanced-features", action="store_true")
        p.add_argument("--train-bounded", action="store_true")
        p.add_argument("--hours", type=float, default=4.0, help="time cap of training with its fallbacks")
        p.add_argument("--model-path", help="a model that was saved, in place of training")
        if name == "fusion":
            p.add_argument("--candidate-topk-grid", type=int_grid, default=[30, 50])
            p.add_argument("--second-model-path")
            p.add_argument("--second-model-weight", type=float, default=0.0)
            for field in RULES:
                p.add_argument(f"--{field.replace('_', '-')}", type=float, default=getattr(Rules(), field))
    return top


def tables(spark: SparkSession, args, target: str) -> flows.Tables:
    files = logs.DataFiles.in_folder(args.data_dir, *([tuple(args.log_files)] if args.log_files else []), items=args.items_file)
    log, items = logs.read_log(spark, files.logs, args.max_rows_per_file), logs.read_items(spark, files.items)
    weights = {CLICK: args.click_weight, FAVOURITE: args.favorite_weight, CART: args.cart_weight, PURCHASE: args.buy_weight}
    return flows.Tables.build(log, items, target, args.lookback_days, args.decay, weights, f"{args.output_dir}/tables")


def model_params(args) -> ModelParams:
    given = {f: getattr(args, f) for f in MODEL if getattr(args, f) is not None}
    return replace(flows.PRESETS[args.preset] if args.preset else ModelParams(), **given)


def _baseline(spark: SparkSession, args) -> tuple[dict, DataFrame | None]:
    k = args.topk or max(args.topk_grid)
    found = flows.baseline(tables(spark, args, args.eval_date), args.topk_grid, k, args.min_score)
    best = flows.override(args.topk, found["best"]["k"])
    pairs = None if args.skip_submit else flows.baseline(tables(spark, args, args.predict_date), [best], best, args.min_score)["predictions"]
    return {"metric_protocol": "per_user", "metrics": found["metrics"], "best": found["best"], "k": best}, pairs


def _model(spark: SparkSession, args, day: flows.Tables, summary: dict):
    if args.model_path:
        return sinks.load_model(args.model_path)

    def attempt(enhanced: bool, ratio: int):
        return flows.rerank(day, args.candidate_topk, args.global_topn_grid, model_params(args), ratio, args.negative_mode, enhanced, bounded=args.train_bounded)

    enhanced, ratio = not args.no_enhanced_features, args.neg_pos_ratio
    plans = [(enhanced, ratio), (False, ratio), (False, max(1, ratio // 2)), (False, max(1, ratio // 4))]
    got = flows.with_fallbacks([lambda p=p: attempt(*p) for p in plans], args.hours)
    summary |= {"train_metrics": got.metrics, "seconds": got.seconds}
    sinks.save_model(got.model, f"{args.output_dir}/model")
    return got.model


def _search(spark: SparkSession, args, k_grid: list[int], rules: Rules, second=None, share: float = 0.0) -> tuple[dict, DataFrame | None]:
    day, summary = tables(spark, args, args.eval_date), {}
    fitted = _model(spark, args, day, summary)
    found = flows.fusion_search(day, fitted, k_grid, args.global_topn_grid, rules, args.global_user_cap, second, share)
    best = found["best"] | {"n": flows.override(args.global_topn, found["best"]["n"])}
    sinks.write_trials(spark, found["trials"], f"{args.output_dir}/trials")
    pairs = None
    if not args.skip_submit:
        pairs = flows.submit(tables(spark, args, args.predict_date), fitted, best, rules, args.global_user_cap, second, share)
    return summary | found | {"best": best, "gate": flows.gate(best["f1"]), "may_submit": flows.may_submit(best["f1"])}, pairs


def run(spark: SparkSession, argv: list[str]) -> dict:
    """Run a flow; returns the summary that it wrote."""
    args = parser().parse_args(argv)
    if args.flow == "baseline":
        summary, pairs = _baseline(spark, args)
    elif args.flow == "rerank":
        summary, pairs = _search(spark, args, [args.candidate_topk], Rules.neutral())
    else:
        second = sinks.load_model(args.second_model_path) if args.second_model_path else None
        rules = Rules(**{f: getattr(args, f) for f in RULES})
        summary, pairs = _search(spark, args, args.candidate_topk_grid, rules, second, args.second_model_weight)
    if pairs is not None:
        sinks.write_tsv(pairs, f"{args.output_dir}/submit")
        summary["submission"] = sinks.check_submission(spark, f"{args.output_dir}/submit")
    sinks.write_json(spark, summary, f"{args.output_dir}/summary.json")
    return summary


if __name__ == "__main__":
    import sys

    print(run(SparkSession.builder.appName("skein").getOrCreate(), sys.argv[1:]))
