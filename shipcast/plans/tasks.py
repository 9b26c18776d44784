"""ml20, ml23: one model task end to end, and what it leaves behind.

prepare (pp01 for the task, labels re-attached by key) -> hold-out split
(stratified for classes) -> folds on the fitting part -> random search per model
family with k-fold CV, oversampling each fold's training part (risk task; D5:
validation rows are never oversampled) -> validation metrics -> selection ->
refit of the best draw on all train rows -> test scores.

Everything lies in the shared folder under a digest of the state of the inputs
and of the search: processed tables, fitted preprocessing, trials, models,
predictions, and last the metrics document, which marks the run as whole.  A run
that starts again goes on from its trials; reports read a finished one.
"""

from __future__ import annotations

import hashlib
import json
import threading

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipcast.operators import encode as E
from shipcast.operators import metrics as MT
from shipcast.operators import models as M
from shipcast.operators import search as S
from shipcast.operators import split as SP
from shipcast.operators.oversample import smote
from shipcast.operators.quantiles import drop_stable, stable, stable_alone
from shipcast.operators.stages import fit_preprocessing, for_task
from shipcast.session import exists, lasting_dir
from shipcast.sources import sinks
from shipcast.sources.shipments import input_state, shipments_table

KEY = "order_id"
#: Part of every digest: raise it when the code changes what it writes.
FORMAT = 3


def folder(spark: SparkSession, sf_dir: str, name: str, *key) -> str:
    """The folder of something that depends on the inputs as they are now and on ``key``."""
    text = json.dumps([FORMAT, sf_dir, input_state(spark, sf_dir), *key], sort_keys=True, default=str)
    return f"{lasting_dir(spark)}/{name}-{hashlib.md5(text.encode()).hexdigest()[:16]}"


# ---------------------------------------------------------------- prepared tables

#: (application, folder): the fit for all tasks; with a task: its own, and the columns it makes.
_FITTED: dict = {}
_FITTING = threading.Lock()


def preprocessing(spark: SparkSession, sf_dir: str, task: str) -> tuple[PipelineModel, DataFrame]:
    """(fitted preprocessing, processed orders) of a task.  Both are fitted and written once, for all
    tasks: a task's are the same without the columns that it leaves out."""
    path, ship = folder(spark, sf_dir, "prepared-all"), shipments_table(spark, sf_dir)
    key = spark.sparkContext.applicationId, path
    with _FITTING:  # tasks that run at once wait for the first
        if key not in _FITTED:
            if not exists(spark, f"{path}/orders/_SUCCESS"):
                fitted = fit_preprocessing(ship.where(F.col("split") == "train"))
                fitted.write().overwrite().save(f"{path}/stages")
                fitted.transform(ship).write.mode("overwrite").parquet(f"{path}/orders")
            _FITTED[key] = PipelineModel.load(f"{path}/stages")
        if (*key, task) not in _FITTED:
            _FITTED[*key, task] = for_task(_FITTED[key], ship, task)
    own, columns = _FITTED[*key, task]
    return own, spark.read.parquet(f"{path}/orders").select(*columns)


def feature_columns(processed: DataFrame, task: str) -> list[str]:
    return [f.name for f in processed.schema.fields if isinstance(f.dataType, (T.NumericType, VectorUDT))
            and f.name not in (KEY, "split", M.LABEL[task])]


def labels(spark: SparkSession, sf_dir: str, task: str) -> DataFrame:
    ship, name = shipments_table(spark, sf_dir), M.LABEL[task]
    if task == "risk":
        return E.encode_labels(ship.select(KEY, name), name, "label").select(KEY, "label")
    return ship.select(KEY, F.col(name).cast("double").alias("label"))


def prepare(spark: SparkSession, sf_dir: str, task: str):
    """(train, test, feature columns): processed features; train carries the
    task label as ``label`` (joined by key, D3)."""
    _, processed = preprocessing(spark, sf_dir, task)
    train = (processed.where(F.col("split") == "train").join(labels(spark, sf_dir, task), KEY)
             .where(F.col("label").isNotNull()))
    return train, processed.where(F.col("split") == "test"), feature_columns(processed, task)


def balancer(task: str):
    """What a task does to rows it trains on, beside class weights."""
    return (lambda rows: smote(rows, "label").drop("is_synthetic")) if task == "risk" else None


# ---------------------------------------------------------------- runs

def _validate(model, val: DataFrame, task: str) -> dict[str, float]:
    pred = model.transform(val)
    kind = M.KIND[task]
    if kind == "regression":
        row = MT.regression_metrics(pred).first().asDict()
        row.update(MT.business_cost(pred).first().asDict())
        names = ("rmse", "mae", "mape", "r2", "business_cost")
    elif kind == "binary":
        from pyspark.ml.functions import vector_to_array
        prob = pred.select("label", vector_to_array("probability")[1].alias("score"), "prediction")
        row = {"areaUnderROC": MT.auc(prob, "label", "score").first()["auc"],
               "auc_hard_label": MT.hard_label_auc(prob, "label", "prediction").first()["auc_hard_label"]}
        names = tuple(row)
    else:
        row, names = {"f1": MT.f1_weighted(pred).first()["f1_weighted"]}, ("f1",)
    return {k: float(row[k]) for k in names if row[k] is not None}


def placed(train: DataFrame, strat: str | None) -> DataFrame:
    """``train`` with its ``fold``, NULL in the hold-out.  Keys and labels alone are ranked;
    the wide rows move once, to their places."""
    split = SP.holdout(train.select(KEY, *([strat] if strat else [])), strat)
    folds = SP.kfold(split.where(F.col("is_val") == 0), strat).select(KEY, "fold")
    held = split.where(F.col("is_val") == 1).select(KEY, F.lit(None).cast("int").alias("fold"))
    return train.join(stable(folds.unionByName(held).dropDuplicates([KEY])), KEY)


def run_task(spark: SparkSession, sf_dir: str, task: str, grids: dict | None = None, n_iter: int | None = None,
             parallelism: int = 5) -> TaskRun:
    """The task's run with these search lists (family -> lists; default: the
    reference's), done if no whole run of it lies in the shared folder."""
    grids = grids or M.GRIDS[task]
    run = TaskRun(spark, folder(spark, sf_dir, f"task-{task}", grids, n_iter, M.N_ITER[task], M.SEED), task)
    if run.whole():
        return run
    fitted, _ = preprocessing(spark, sf_dir, task)
    train, test, cols = prepare(spark, sf_dir, task)
    strat = "label" if M.KIND[task] != "regression" else None
    rows = stable_alone(lambda: M.assemble(placed(train, strat), cols)[0].select("label", "fold", "features"))
    fit_part = rows.where(F.col("fold").isNotNull())
    val = rows.where(F.col("fold").isNull()).select("label", "features")
    results = {}
    for family in grids:
        model, params, cv, _ = S.random_search(fit_part, task, family, n_iter, grids[family], balancer(task),
                                               parallelism, run.trials)
        results[family] = {"cv_metric": cv, "params": params, "metrics": _validate(model, val, task)}
    drop_stable(rows)
    metric, minimize = M.SELECT_METRIC[task]
    table = spark.createDataFrame([(f, k, x["metrics"].get(metric)) for k, (f, x) in enumerate(results.items())],
                                  f"model string, seq int, {metric} double")  # one row per family
    best = M.select_best(table, metric, minimize).where(F.col("is_best") == 1).first()["model"]
    final = refit(train, cols, task, best, results[best]["params"])
    whole = PipelineModel([*fitted.stages, VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error"), final])
    sinks.save_model(whole, run.path + "/model")
    M.score(final, M.assemble(test, cols)[0], task).write.mode("overwrite").parquet(run.path + "/predictions")
    sinks.write_metrics_document(spark, run.path + "/metrics", task, best, results)
    return run


def refit(train: DataFrame, cols: list[str], task: str, family: str, params: dict):
    """ml20: these parameters fitted on all train rows (risk: after oversampling them)."""
    plain = M.assemble(train, cols)[0].select("label", "features")
    balance = balancer(task)
    if not balance:
        return M.fit_one(plain, task, family, params)
    rows = stable_alone(lambda: balance(plain))
    try:
        return M.fit_one(rows, task, family, params)
    finally:
        drop_stable(rows)


class TaskRun:
    """A task's results in the shared folder."""

    def __init__(self, spark: SparkSession, path: str, task: str):
        self.spark, self.path, self.task = spark, path, task
        self.trials = S.Trials(spark, f"{path}/trials")

    def whole(self) -> bool:
        return exists(self.spark, f"{self.path}/metrics/_SUCCESS")

    def document(self) -> DataFrame:
        """One row: task, best_model, best_params, results (model -> cv_metric, params, metrics)."""
        return sinks.read_metrics_document(self.spark, f"{self.path}/metrics")

    def metrics(self) -> DataFrame:
        """One row per family: cross-validation score, parameters, validation metrics, is_best."""
        return (self.document().select("best_model", F.explode("results").alias("model", "result"))
                .select("model", "result.cv_metric", "result.params", "result.metrics",
                        (F.col("model") == F.col("best_model")).cast("int").alias("is_best")))

    def predictions(self) -> DataFrame:
        """Test predictions of the selected model, refit on all train rows: order_id, prediction."""
        return self.spark.read.parquet(f"{self.path}/predictions")

    def model(self) -> PipelineModel:
        """Raw orders to predictions: the fitted preprocessing, assembler and learner."""
        return PipelineModel.load(f"{self.path}/model")


# ---------------------------------------------------------------- single fits

def fitted(spark: SparkSession, sf_dir: str, task: str, family: str, params: dict | None = None):
    """These parameters (default: the family's first drawn set) fitted on all train rows, once per state of the inputs."""
    params = params or M.draw_params(M.GRIDS[task][M.LISTS_OF.get(family, family)], 1)[0]
    path = folder(spark, sf_dir, f"model-{task}-{family}", params)
    loader = M.loader(family, M.KIND[task])
    if not exists(spark, f"{path}/done/_SUCCESS"):
        train, _, cols = prepare(spark, sf_dir, task)
        model = M.fit_one(M.assemble(train, cols)[0].select("label", "features"), task, family, params)
        sinks.save_model(model, f"{path}/model")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/done")
        return model
    return loader.load(f"{path}/model")
