"""Model operators on ``pyspark.ml`` (ml07-ml12, ml18, ml21, ml22).

* Feature matrix: ``VectorAssembler`` over the numeric family (ml22).
* Learners: Spark's random forest, gradient-boosted trees (one-vs-rest for
  three classes; as family SoftmaxGBT one model over all classes), and L2
  logistic regression stand in for the reference's forest / boosting / logistic
  models.  Parameter lists are the reference's;
  each is mapped to the nearest Spark parameter (see ``_estimator``).
* Search (ml13): ``n_iter`` parameter sets drawn with a fixed seed; the search
  itself is in ``shipcast.operators.search``.
* Selection (ml18): a metrics table, best row by the task metric, ties to the
  earlier model.
"""

from __future__ import annotations

import itertools
import random

from pyspark.ml.classification import (GBTClassifier, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipcast.functions.columns import numeric_columns
from shipcast.operators.boosting import SoftmaxBoosting, SoftmaxBoostingModel
from shipcast.operators.forest import fit_boosted, fit_forest, fit_one_vs_rest

SEED = 42
KEY = "order_id"
N_FOLDS = 5

# The reference's search lists per task and model family.
GRIDS = {
    "risk": {
        "RandomForest": {"n_estimators": [100, 150, 200], "max_depth": [10, 15, 20],
                         "min_samples_split": [5, 10], "max_features": ["sqrt", "log2"]},
        "GBT": {"n_estimators": [100, 150, 200], "max_depth": [6, 8, 10], "learning_rate": [0.01, 0.05, 0.1],
                "subsample": [0.7, 0.8, 0.9], "colsample_bytree": [0.7, 0.8, 0.9]},
    },
    "cost": {
        "RandomForest": {"n_estimators": [100, 150, 200], "max_depth": [15, 20, 25],
                         "min_samples_split": [5, 10, 15], "min_samples_leaf": [2, 5, 10],
                         "max_features": ["sqrt", "log2"]},
        "GBT": {"n_estimators": [100, 150, 200], "max_depth": [6, 8, 10], "learning_rate": [0.01, 0.05, 0.1],
                "subsample": [0.7, 0.8, 0.9], "colsample_bytree": [0.7, 0.8, 0.9], "gamma": [0, 0.1, 0.2],
                "min_child_weight": [1, 3, 5]},
    },
    "delay": {
        "Logistic": {"C": [0.01, 0.1, 1, 10]},
        "RandomForest": {"n_estimators": [100, 150, 200], "max_depth": [10, 15, 20],
                         "min_samples_split": [5, 10], "max_features": ["sqrt", "log2"]},
        "GBT": {"n_estimators": [100, 150, 200], "max_depth": [6, 8, 10], "learning_rate": [0.01, 0.05, 0.1],
                "subsample": [0.7, 0.8, 0.9]},
    },
    "inventory": {
        "RandomForest": {"n_estimators": [100, 150, 200], "max_depth": [15, 20, 25],
                         "min_samples_split": [5, 10, 15], "max_features": ["sqrt", "log2"]},
        "GBT": {"n_estimators": [100, 150, 200], "max_depth": [6, 8, 10], "learning_rate": [0.01, 0.05, 0.1],
                "subsample": [0.7, 0.8, 0.9], "colsample_bytree": [0.7, 0.8, 0.9]},
    },
}
#: Families that draw from another's lists.
LISTS_OF = {"SoftmaxGBT": "GBT"}
N_ITER = {"risk": 2, "cost": 5, "delay": 5, "inventory": 5}
KIND = {"risk": "multiclass", "cost": "regression", "delay": "binary", "inventory": "regression"}
LABEL = {"risk": "supply_chain_disruption_risk", "cost": "realistic_total_cost",
         "delay": "will_be_delayed", "inventory": "optimal_stock_days"}
# Metric the task selects on, and whether smaller is better.
SELECT_METRIC = {"risk": ("f1", False), "cost": ("rmse", True), "delay": ("areaUnderROC", False),
                 "inventory": ("business_cost", True)}
MAX_SPARK_DEPTH = 30


# ---------------------------------------------------------------- features

def assemble(df: DataFrame, feature_cols: list[str] | None = None, out: str = "features",
             exclude=(KEY, "label", "split", "fold", "weight", "is_val")) -> tuple[DataFrame, list[str]]:
    """ml22: numeric and vector columns -> one vector column (a NULL is an error)."""
    cols = feature_cols or numeric_columns(df, exclude=exclude)
    va = VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error")
    return va.transform(df), cols


# ---------------------------------------------------------------- search space

def draw_params(grid: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """ml13: ``n_iter`` distinct parameter sets drawn from the grid lists."""
    keys = sorted(grid)
    combos = [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]
    rng = random.Random(seed)
    return rng.sample(combos, min(n_iter, len(combos)))


def _estimator(family: str, kind: str, params: dict, weight_col: str | None, n_rows: int | None = None):
    """Reference parameters -> Spark estimator (nearest equivalents:
    min_samples_split ~ minInstancesPerNode * 2, min_samples_leaf and
    min_child_weight ~ minInstancesPerNode, gamma ~ minInfoGain,
    colsample_bytree ~ featureSubsetStrategy fraction, C ~ regParam = 1/C)."""
    p = params
    common = {"labelCol": "label", "featuresCol": "features", "seed": SEED}
    if family == "RandomForest":
        leaf = max(int(p.get("min_samples_leaf", 1)), int(p.get("min_samples_split", 2)) // 2)
        kw = dict(numTrees=int(p["n_estimators"]), maxDepth=min(int(p["max_depth"]), MAX_SPARK_DEPTH),
                  minInstancesPerNode=leaf, featureSubsetStrategy=p.get("max_features", "sqrt"), **common)
        if kind == "regression":
            return RandomForestRegressor(**kw)
        return RandomForestClassifier(weightCol=weight_col, **kw) if weight_col else RandomForestClassifier(**kw)
    if family in ("GBT", "SoftmaxGBT"):
        if family == "SoftmaxGBT" and kind != "multiclass":
            raise ValueError("SoftmaxGBT is for classes")
        kw = dict(maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]),
                  subsamplingRate=float(p.get("subsample", 1.0)),
                  featureSubsetStrategy=str(p.get("colsample_bytree", 1.0)),
                  minInfoGain=float(p.get("gamma", 0.0)),
                  minInstancesPerNode=int(p.get("min_child_weight", 1)), **common)
        if kind == "regression":
            return GBTRegressor(**kw)
        if kind == "binary":
            return GBTClassifier(weightCol=weight_col, **kw) if weight_col else GBTClassifier(**kw)
        if family == "SoftmaxGBT":
            return SoftmaxBoosting(**{k: v for k, v in kw.items() if k not in ("labelCol", "featuresCol")})
        # The per-class models are independent Spark jobs: fit them together.
        return OneVsRest(classifier=GBTClassifier(**kw), labelCol="label", featuresCol="features",
                         parallelism=3)
    if family == "Logistic":
        # sklearn minimises C * sum(loss) + |w|^2 / 2; Spark minimises
        # mean(loss) + regParam * |w|^2 / 2, so regParam = 1 / (C * n).
        reg = 1.0 / (float(p["C"]) * max(n_rows or 1, 1))
        # tol 1e-4 is the reference learner's default stopping tolerance.
        kw = dict(regParam=reg, elasticNetParam=0.0, maxIter=1000, tol=1e-4, standardization=False,
                  labelCol="label", featuresCol="features")
        return LogisticRegression(weightCol=weight_col, **kw) if weight_col else LogisticRegression(**kw)
    raise ValueError(f"unknown model family {family!r}")


# ---------------------------------------------------------------- fits

def weighted(train: DataFrame, task: str, family: str) -> tuple[DataFrame, str | None]:
    """Class weights as the reference sets them: balanced for the forests of the
    class tasks, the negative/positive ratio on positives for the delay booster."""
    from shipcast.operators.split import class_weights, with_weights
    if family == "RandomForest" and KIND[task] != "regression":
        return with_weights(train, "label", "weight"), "weight"
    if family == "GBT" and KIND[task] == "binary":
        ratio = class_weights(train, "label").where("label = 1").first()
        positive = float(ratio["pos_weight"] or 1.0) if ratio else 1.0
        return train.withColumn("weight", F.when(F.col("label") == 1, positive).otherwise(1.0)), "weight"
    return train, None


def fit_one(train: DataFrame, task: str, family: str, params: dict):
    """One fit with the task's weights; ``train`` has label and features."""
    rows, weight = weighted(train, task, family)
    n_rows = None
    if family == "Logistic":
        n_rows = train.count()
        # The names of all slots would go out with every task of every loss evaluation;
        # trees need them, since they tell which slots are 0/1.
        rows = rows.withColumn("features", F.col("features").alias("features", metadata={}))
    estimator = _estimator(family, KIND[task], params, weight, n_rows)
    if family == "RandomForest":
        return fit_forest(rows, estimator, KIND[task] != "regression")
    if family == "GBT":
        return fit_one_vs_rest(rows, estimator) if KIND[task] == "multiclass" else fit_boosted(rows, estimator, KIND[task] == "binary")
    return estimator.fit(rows)


def loader(family: str, kind: str):
    """The class that reads back a saved fit of ``fit_one``."""
    from pyspark.ml import classification as C
    from pyspark.ml import regression as R
    if family == "Logistic":
        return C.LogisticRegressionModel
    if family == "SoftmaxGBT":
        return SoftmaxBoostingModel
    if kind == "regression":
        return R.RandomForestRegressionModel if family == "RandomForest" else R.GBTRegressionModel
    if family == "RandomForest":
        return C.RandomForestClassificationModel
    return C.GBTClassificationModel if kind == "binary" else C.OneVsRestModel


def select_best(metrics: DataFrame, metric: str, minimize: bool, seq: str = "seq") -> DataFrame:
    """ml18: mark the best model (first ``seq`` wins ties)."""
    o = F.col(metric).asc_nulls_last() if minimize else F.col(metric).desc_nulls_last()
    w = Window.orderBy(o, F.col(seq))  # over one row per model
    return metrics.withColumn("is_best", (F.row_number().over(w) == 1).cast("int"))


def score(model, df: DataFrame, task: str) -> DataFrame:
    """ml21: (order_id, prediction); risk classes are decoded to names."""
    from shipcast.operators.encode import decode_labels
    out = model.transform(df).select(KEY, "prediction")
    if task == "risk":
        out = decode_labels(out, "prediction", "prediction")
    elif task == "delay":
        out = out.withColumn("prediction", F.col("prediction").cast("int"))
    return out
