"""Ranking features (X1-X26) and the rule factors (H1-H5) as SQL expressions over candidate columns.

The registry is data: a name and an expression. Numbers are doubles throughout (a
plain 1.0 would be a decimal). Only features whose inputs exist are made.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.scalars import finite, is_non_finite
from skein.schema import COUNTS, NO_GAP

_WORD = re.compile(r"(?<![\w.])[a-z_][a-z_0-9]*")
_FUNCTIONS = {"try_cast", "log1p", "sqrt", "greatest", "least", "cast", "as", "double", "case", "when", "then", "else", "end", "and", "or", "coalesce"}
#: Smooths divisions.
EPSILON = "0.000001D"
#: A rank that is missing, or no number, is 999.
_RANK = "coalesce(try_cast(rn as double), 999.0D)"


def _std(side: str, count: str) -> str:
    """From moments, not below 0."""
    mean = f"{side}_score_mean"
    return f"sqrt(greatest({side}_score_sq_sum / ({count} + {EPSILON}) - {mean} * {mean}, 0.0D))"


def _engage(s: str, days: int) -> str:
    return f"({s}_b1_{days}d + 3.0D * {s}_b2_{days}d + 6.0D * {s}_b3_{days}d + 10.0D * {s}_b4_{days}d)"


def _inverse(s: str) -> str:
    return f"(1.0D / (least(greatest({s}_last_hours_gap, 0), {NO_GAP}) + 1.0D))"


def registry(enhanced: bool = True) -> dict[str, str]:
    """All features by name."""
    out = {
        "score": "score", "rn": _RANK, "log_score": "log1p(score)",
        "user_score_std": _std("user", "user_candidate_count"), "item_score_std": _std("item", "item_candidate_user_count"),
        "rank_inv": f"1.0D / {_RANK}", "rank_pct": f"{_RANK} / (user_candidate_count + {EPSILON})",
        "score_div_user_max": f"score / (user_score_max + {EPSILON})", "score_div_user_sum": f"score / (user_score_sum + {EPSILON})",
        "score_minus_user_mean": "score - user_score_mean", "score_minus_item_mean": "score - item_score_mean",
        "user_candidate_count_log": "log1p(user_candidate_count)", "item_candidate_user_count_log": "log1p(item_candidate_user_count)",
        "user_score_mean": "user_score_mean", "user_candidate_count": "user_candidate_count",
        "item_score_mean": "item_score_mean", "item_candidate_user_count": "item_candidate_user_count",
    }
    for s in ("p", "u", "i", "c", "uc"):
        out[f"{s}_last_hours_gap_inv"] = _inverse(s)
        for name, b in (("click", 1), ("fav", 2), ("cart", 3)):
            out[f"{s}_buy_{name}_ratio_14d"] = f"{s}_b4_14d / ({s}_b{b}_14d + 1.0D)"
        out[f"{s}_engage_14d"], out[f"{s}_engage_1d"] = _engage(s, 14), _engage(s, 1)
        out[f"{s}_last_hours_gap"] = f"least(greatest({s}_last_hours_gap, 0), {NO_GAP})"
        out |= {f"{s}_{n}": f"{s}_{n}" for n, _, _ in COUNTS}
        if enhanced and s in ("p", "c", "uc"):
            out[f"{s}_buy_click_ratio_14d_s"] = f"({s}_b4_14d + 1.0D) / ({s}_b1_14d + 2.0D)"
            out[f"{s}_buy_cart_ratio_14d_s"] = f"({s}_b4_14d + 1.0D) / ({s}_b3_14d + 2.0D)"
    for what, b in (("buy", 4), ("cart", 3)):
        for name, s in (("user", "u"), ("item", "i"), ("cat", "c"), ("uc", "uc")):
            out[f"p_{what}_share_{name}_14d"] = f"p_b{b}_14d / ({s}_b{b}_14d + 1.0D)"
    out["item_category"] = "cast(item_category as double)"
    if enhanced:
        out["recency_intent_cross"] = f"least(greatest(24.0D * {_inverse('p')}, 0.0D), 1.0D) * log1p(greatest({_engage('p', 1)}, 0.0D))"
        out["pair_share_in_user_1d"] = f"{_engage('p', 1)} / ({_engage('u', 1)} + 1.0D)"
        out["pair_share_in_uc_1d"] = f"{_engage('p', 1)} / ({_engage('uc', 1)} + 1.0D)"
        out["strong_intent_flag"] = "case when (p_b2_1d > 0 or p_b3_1d > 0) and p_b4_1d <= 0 then 1.0D else 0.0D end"
        out["zombie_item_flag"] = "case when i_b1_14d + i_b2_14d + i_b3_14d >= 60 and i_b4_14d <= 0 then 1.0D else 0.0D end"
    return out


def inputs(expression: str) -> set[str]:
    return {w for w in _WORD.findall(expression) if w not in _FUNCTIONS}


def expressions(columns, enhanced: bool = True) -> dict[str, str]:
    """The features that can be made from ``columns``; a deviation that is there already serves where its moments are not."""
    have = set(columns)
    given = {n: n for n in ("user_score_std", "item_score_std") if n in have}
    return given | {n: e for n, e in registry(enhanced).items() if inputs(e) <= have}


def names(columns, enhanced: bool = True) -> list[str]:
    """The features that can be made from ``columns``, sorted."""
    return sorted(expressions(columns, enhanced))


def raw(candidates: DataFrame, enhanced: bool = True, only: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``user_id, item_id`` and the features as computed; and their names."""
    every = expressions(candidates.columns, enhanced)
    made = [n for n in (only or sorted(every)) if n in every]
    keep = [c for c in ("user_id", "item_id") if c not in made]
    return candidates.select(*keep, *(F.expr(every[n]).alias(n) for n in made)), made


def build(candidates: DataFrame, enhanced: bool = True, only: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """:func:`raw` with finite values."""
    frame, made = raw(candidates, enhanced, only)
    return frame.select(*(c for c in frame.columns if c not in made), *(finite(F.col(n)).alias(n) for n in made)), made


def aligned(frame: DataFrame, wanted: list[str]) -> DataFrame:
    """Features that are not there become 0."""
    return frame.withColumns({n: F.lit(0.0) for n in wanted if n not in frame.columns})


def non_finite(frame: DataFrame, columns: list[str]) -> DataFrame:
    """How many values are null, NaN or infinite."""
    total = sum((F.coalesce(F.sum(F.when(is_non_finite(F.col(c)), 1).otherwise(0)), F.lit(0)) for c in columns), F.lit(0))
    return frame.agg(total.cast("long").alias("n_non_finite"))


@dataclass(frozen=True)
class Rules:
    """H1-H5; the defaults are fixed values. :meth:`neutral` leaves scores as they are."""

    zombie_click_threshold: float = 60.0
    zombie_penalty: float = 0.05
    strong_bonus: float = 0.25
    loyalty_weight: float = 0.5
    cvr_weight: float = 0.25
    recency_weight: float = 0.1

    @staticmethod
    def neutral() -> Rules:
        return Rules(60.0, 1.0, 0.0, 0.0, 0.0, 0.0)

    def factors(self) -> dict[str, str]:
        d = {k: f"{float(v)!r}D" for k, v in vars(self).items()}
        return {
            "strong": f"(1.0D + {d['strong_bonus']} * case when p_b2_1d > 0 or p_b3_1d > 0 or p_b4_1d > 0 then 1.0D else 0.0D end)",
            "loyalty": f"(1.0D + {d['loyalty_weight']} * least(greatest({_engage('p', 1)} / ({_engage('u', 1)} + 1.0D), 0.0D), 1.5D))",
            "cvr": f"(1.0D + {d['cvr_weight']} * least(greatest(i_b4_14d / (i_b1_14d + 1.0D), 0.0D), 1.0D))",
            "recency": f"(1.0D + {d['recency_weight']} * least(greatest(24.0D * {_inverse('p')}, 0.0D), 1.0D))",
            "zombie": f"case when i_b1_14d >= {d['zombie_click_threshold']} and i_b4_14d <= {EPSILON} then {d['zombie_penalty']} else 1.0D end",
        }


def hybrid(candidates: DataFrame, probability: str, rules: Rules = Rules()) -> DataFrame:
    """``hybrid``: the probability times the factors whose inputs exist."""
    out = F.col(probability).cast("double")
    for e in rules.factors().values():
        if inputs(e) <= set(candidates.columns):
            out = out * F.expr(e)
    return candidates.withColumn("hybrid", finite(out))
