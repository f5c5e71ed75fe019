"""The classifier (M8, M10, M11) and its search (M12, M13): gradient-boosted trees of MLlib."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.scalars import blend
from skein.operators import features, sampling


@dataclass(frozen=True)
class ModelParams:
    """``num_leaves`` sets the depth; trees here grow by level."""

    num_boost_round: int = 300
    learning_rate: float = 0.05
    num_leaves: int = 63
    min_data_in_leaf: int = 50
    feature_fraction: float = 0.9
    bagging_fraction: float = 0.8
    valid_ratio: float = 0.1
    early_stopping_gain: float = 0.01
    seed: int = 42


def train(rows: DataFrame, names: list[str], params: ModelParams = ModelParams()) -> PipelineModel:
    """Fit to ``label`` with classes of equal weight and early stopping on a held-out share.

    Stops where the held-out loss gains less than ``early_stopping_gain`` of itself; too few rows for a held-out share: no stopping.
    """
    rows = rows.persist()
    sampling.require_both_classes(rows)
    bad = features.non_finite(rows, names).first()[0]
    if bad:
        raise ValueError(f"{bad} values are not finite")
    n = {r.label: r.n_rows for r in sampling.class_counts(rows).collect()}
    marked = sampling.random_split(rows, params.valid_ratio, params.seed)
    marked = marked.withColumn("weight", F.when(F.col("label") == 1, F.lit(n[0] / n[1])).otherwise(F.lit(1.0))).withColumn("label", F.col("label").cast("double"))
    sides = {r.is_valid for r in marked.select("is_valid").distinct().collect()}
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", lossType="logistic", validationTol=params.early_stopping_gain,
        maxIter=params.num_boost_round, stepSize=params.learning_rate, maxDepth=min(30, max(1, math.ceil(math.log2(params.num_leaves)))),
        minInstancesPerNode=params.min_data_in_leaf, featureSubsetStrategy=str(params.feature_fraction), subsamplingRate=params.bagging_fraction, seed=params.seed,
    )
    if len(sides) == 2:
        trees.setValidationIndicatorCol("is_valid")
    try:
        return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), trees]).fit(marked)
    finally:
        rows.unpersist()


def feature_names(model: PipelineModel) -> list[str]:
    """The features come from the model, not from the caller."""
    return model.stages[0].getInputCols()


def predict(model: PipelineModel, rows: DataFrame, name: str = "probability_1") -> DataFrame:
    """The probability of class 1; missing features are 0."""
    out = model.transform(features.aligned(rows, feature_names(model)))
    return out.withColumn(name, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def predict_two(first: PipelineModel, second: PipelineModel, rows: DataFrame, share: float, name: str = "probability_1") -> DataFrame:
    """M11."""
    both = predict(second, predict(first, rows, "__a"), "__b")
    return both.withColumn(name, blend(F.col("__a"), F.col("__b"), share)).drop("__a", "__b")


#: The search space (low, high, whether on a logarithmic scale).
SPACE = {
    "learning_rate": (0.01, 0.15, True), "num_leaves": (31, 255, False), "min_data_in_leaf": (20, 200, False),
    "feature_fraction": (0.6, 1.0, False), "bagging_fraction": (0.5, 1.0, False), "num_boost_round": (200, 800, False), "neg_pos_ratio": (10, 80, False),
}


def draw(rng: random.Random) -> dict:
    out = {}
    for name, (low, high, log) in SPACE.items():
        x = math.exp(rng.uniform(math.log(low), math.log(high))) if log else rng.uniform(low, high)
        out[name] = round(x) if isinstance(low, int) else x
    return out


def search(objective: Callable[[dict], float], n_trials: int = 25, timeout: float = 0, seed: int = 42) -> tuple[dict, list[dict]]:
    """Seeded random search in place of a Parzen estimator; the best trial (the first among equals) and all trials."""
    rng, trials, begun = random.Random(seed), [], time.monotonic()
    for k in range(n_trials):
        if timeout and trials and time.monotonic() - begun > timeout:
            break
        params = draw(rng)
        trials.append({"trial": k, "f1": float(objective(params))} | params)
    return max(trials, key=lambda t: (t["f1"], -t["trial"])), trials


def as_dict(params: ModelParams) -> dict:
    return asdict(params)
