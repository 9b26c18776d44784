"""Forests over sparse rows against Spark's own learner."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from shipcast.operators import boosting, forest
from shipcast.operators import models as M
from shipcast.operators.quantiles import stable


@pytest.fixture(autouse=True)
def never_dense(monkeypatch):
    monkeypatch.setattr(forest, "DENSE", 0)


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers, some of them zero, and a column of 30 values as 0/1 slots; y depends on both."""
    rng, n = np.random.default_rng(1), 3000
    x, code = rng.normal(size=(n, 3)), rng.integers(0, 30, n)
    x[rng.random((n, 3)) < 0.2] = 0
    y = x[:, 0] + 2 * rng.normal(size=30)[code] + (x[:, 1] > 0.3) * x[:, 2] + 0.1 * rng.normal(size=n)
    df = spark.createDataFrame([(float(a), *map(float, b), float(c)) for a, b, c in zip(y, x, code)],
                               "y double, a double, b double, c double, code double").repartition(4)
    hot = OneHotEncoder(inputCols=["code"], outputCols=["v"]).fit(df).transform(df)
    out = VectorAssembler(inputCols=["a", "v", "b", "c"], outputCol="features").transform(hot)
    return stable(out.select("y", "features", (F.pmod(F.xxhash64("y"), F.lit(3)) + 1.0).alias("w")))


CLASS = "double(y > 0) + double(y > 1)"


@pytest.mark.parametrize("kind, label, options", [
    (RandomForestRegressor, "y", dict(maxDepth=6, minInstancesPerNode=5)),
    (RandomForestRegressor, "y", dict(maxDepth=9, weightCol="w", minInfoGain=0.01)),
    (RandomForestClassifier, CLASS, dict(maxDepth=6, weightCol="w"))])
def test_without_draws_the_trees_are_sparks(rows, monkeypatch, kind, label, options):
    monkeypatch.setattr(forest, "BLOCK", 500)
    monkeypatch.setattr(forest, "PASS", 1000)  # several passes a level
    df = rows.withColumn("label", F.expr(label))
    est = kind(numTrees=1, bootstrap=False, featureSubsetStrategy="all", **options)
    mine, own = forest.fit_forest(df, est, kind is RandomForestClassifier), est.fit(df)
    assert type(mine) is type(own) and mine.totalNumNodes == own.totalNumNodes > 20 and mine.getMaxDepth() == options["maxDepth"]
    out = "probability" if kind is RandomForestClassifier else "prediction"
    both = own.transform(df).withColumnRenamed(out, "theirs").select("features", "theirs")
    for r in mine.transform(both.withColumn("k", F.lit(1))).select(out, "theirs").collect():
        assert np.allclose(r[0].toArray() if out == "probability" else r[0], r[1].toArray() if out == "probability" else r[1], atol=1e-9)


@pytest.mark.parametrize("task", ["cost", "risk"])
def test_forests_score_as_sparks_do(rows, task, tmp_path):
    df = rows.select(F.expr("y" if task == "cost" else CLASS).alias("label"), "features")
    train, held = (stable(d) for d in df.randomSplit([0.7, 0.3], 3))
    params = {"n_estimators": 80, "max_depth": 8, "min_samples_leaf": 2, "max_features": "sqrt"}
    mine = M.fit_one(train, task, "RandomForest", params)
    weighted, weight = M.weighted(train, task, "RandomForest")
    own = M._estimator("RandomForest", M.KIND[task], params, weight).fit(weighted)
    score = (F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2)) if task == "cost"
             else F.avg((F.col("label") != F.col("prediction")).cast("double")))
    a, b = (m.transform(held).agg(score).first()[0] for m in (mine, own))
    assert a < 1.15 * b and mine.getNumTrees == 80
    mine.save(f"{tmp_path}/m")
    again = M.loader("RandomForest", M.KIND[task]).load(f"{tmp_path}/m")
    assert again.toDebugString == mine.toDebugString
    assert M.fit_one(train, task, "RandomForest", params).toDebugString.split("\n")[1:] == mine.toDebugString.split("\n")[1:]


@pytest.mark.parametrize("task", ["inventory", "delay", "risk"])
def test_boosting_without_draws_is_sparks(rows, task, tmp_path, monkeypatch):
    monkeypatch.setattr(forest, "ROUNDS", 2)
    label = {"inventory": "y", "delay": "double(y > 0)", "risk": CLASS}[task]
    df = rows.select(F.expr(label).alias("label"), "features")
    params = {"n_estimators": 4, "max_depth": 4, "learning_rate": 0.3, "min_child_weight": 3}
    mine = M.fit_one(df, task, "GBT", params)
    weighted, weight = M.weighted(df, task, "GBT")
    own = M._estimator("GBT", M.KIND[task], params, weight).fit(weighted)
    assert type(mine) is type(own)
    out = "prediction" if task == "inventory" else "rawPrediction"
    mine.save(f"{tmp_path}/m")
    again = M.loader("GBT", M.KIND[task]).load(f"{tmp_path}/m")
    pairs = again.transform(own.transform(df).select("features", F.col(out).alias("theirs"))).select(out, "theirs").collect()
    a, b = (np.array([r[k] if task == "inventory" else r[k].toArray() for r in pairs]) for k in (0, 1))
    # Of equal gains, which gradients of few values give, rounding chooses; so a few rows may differ.
    same = np.isclose(a, b, atol=1e-7)
    assert same.mean() > 0.98 and (task == "risk" or same.all()) and a.std() > 0.1


def test_softmax_boosting_without_draws_is_sparks(rows, monkeypatch):
    """All classes in one job a level give the trees of one fit of Spark's learner a class and round.  Slots have
    few values, since Spark places the cuts of others anew in every round, by the weights."""
    df = rows.select(F.expr(CLASS).cast("int").alias("label"), array_to_vector(F.transform(
        vector_to_array("features"), lambda x: F.round(3 * x) / 3)).alias("features"))
    options = dict(maxIter=3, maxDepth=4, stepSize=0.3, minInstancesPerNode=3)
    monkeypatch.setattr(boosting, "RandomForestRegressor", type("Own", (RandomForestRegressor,), {"fit": None}))
    monkeypatch.setattr(forest, "ROUNDS", 2)
    mine = boosting.SoftmaxBoosting(**options).fit(df)
    monkeypatch.undo()  # DENSE too: Spark's learner
    own = boosting.SoftmaxBoosting(**options).fit(df)
    assert len(mine.margins) == 3 and len(mine.losses) == 2 and mine.losses[-1] == pytest.approx(own.losses[-1], abs=1e-4)
    pairs = mine.transform(df.withColumn("k", F.lit(1))).withColumnRenamed("probability", "mine").drop("prediction")
    got = own.transform(pairs).select("mine", "probability").collect()
    assert np.mean([np.allclose(a.toArray(), b.toArray(), atol=1e-7) for a, b in got]) > 0.98


def test_sums_are_shuffled_in_parts(rows, spark):
    """A task sends a row a part, not one for every node, slot and bin that it has met."""
    df = rows.select(F.col("y").alias("label"), F.lit(1.0).alias("weight"), "features")
    size, hot = 32, np.arange(1, 30)
    bins = forest.Bins(size, hot, *forest.find_cuts(df, 3000, hot, 32, 1))
    blocks = stable(forest.pack(df, bins).repartition(4))
    options = {"classes": 0, "seed": 1, "rate": 1.0, "bootstrap": False, "loss": None, "least": 1}
    tree = forest.Tree(forest.totals_of(blocks, 1, bins, options)[0])
    todo = forest.Pass([(0, 0)], [np.arange(size)], np.array([tree.stats[0]]), bins)
    shared = spark.sparkContext.broadcast((todo, [tree.shape()]))
    sums = forest.add_up(blocks, shared, options)
    met, n = sums.agg(F.sum(F.length("at") / 4), F.count(F.lit(1))).first()
    assert n <= 4 < 100 < met and len(todo.parts) == 2
    assert len(forest.best_cuts(sums, shared, options, 1).collect()) == 1


def test_a_row_costs_its_entries_not_the_slots(spark):
    """2,000 rows of two million slots, of which a row uses two: as one bin a slot they would take 16 GB."""
    rng, size = np.random.default_rng(2), 2_000_000
    code, x = rng.integers(0, 20, 2000), rng.normal(size=2000)
    df = stable(spark.createDataFrame([(float(10 * (c % 2) + v), Vectors.sparse(size, [0, 7 + 90_000 * int(c)], [float(v), 1.0]))
                                       for c, v in zip(code, x)], ["label", "features"]).repartition(3))
    est = RandomForestRegressor(numTrees=2, maxDepth=4, featureSubsetStrategy="all", seed=1)
    fitted = forest.fit_forest(df, est, False)
    assert fitted.numFeatures == size
    assert fitted.transform(df).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0] < 4.9
    blocks = forest.pack(df.withColumn("weight", F.lit(1.0)), forest.Bins(size, np.arange(size), {}))
    assert blocks.agg(F.sum(F.length("slots") / 4 + F.length("bins"))).first()[0] <= 2 * 2 * 2000


def test_small_tables_go_to_sparks_learner(rows, monkeypatch):
    monkeypatch.setattr(forest, "DENSE", 1 << 28)
    monkeypatch.setattr(forest, "grow", None)
    df = rows.select(F.col("y").alias("label"), "features")
    assert M.fit_one(df, "cost", "RandomForest", {"n_estimators": 2, "max_depth": 2}).getNumTrees == 2
    with pytest.raises(TypeError):
        monkeypatch.setattr(forest, "DENSE", 3000 * 32 - 1)
        M.fit_one(df, "cost", "RandomForest", {"n_estimators": 2, "max_depth": 2})


def test_draws_and_bags():
    rng = np.random.default_rng(3)
    seen = np.bincount(np.concatenate([forest.draw_slots(rng, 50, 8) for _ in range(2000)]), minlength=50)
    assert seen.sum() == 16000 and (abs(seen / 2000 - 0.16) < 0.05).all()
    assert [forest.slots_for(s, 6166, 10, c) for s, c in (("sqrt", True), ("log2", True), ("auto", True), ("auto", False),
                                                          ("all", True), ("0.5", False), ("7", False))] == [79, 13, 79, 2056, 6166, 3083, 7]


def test_forests_of_small_inputs(spark):
    same = spark.createDataFrame([(5.0, Vectors.dense([float(k)])) for k in range(6)], ["label", "features"])
    fitted = forest.fit_forest(same, RandomForestRegressor(numTrees=3, seed=1), False)
    assert {r.prediction for r in fitted.transform(same).collect()} == {5.0} and fitted.totalNumNodes == 3
    one = forest.fit_forest(same.withColumn("label", F.lit(1)), RandomForestClassifier(numTrees=3, seed=1), True)
    assert {r.prediction for r in one.transform(same).collect()} == {1.0}
    with pytest.raises(ValueError):
        forest.fit_forest(same.where("1 = 0"), RandomForestRegressor(), False)


@pytest.mark.parametrize("task", ["inventory", "delay", "risk"])
def test_boosting_a_small_table_is_one_task_and_sparks_result(rows, task, monkeypatch):
    monkeypatch.setattr(forest, "DENSE", 1 << 28)
    monkeypatch.setattr(forest, "BLOCK", 700)
    monkeypatch.setattr(forest, "PASS", 1000)  # several passes a level
    label = {"inventory": "y", "delay": "double(y > 0)", "risk": CLASS}[task]
    df = stable(rows.select(F.expr(label).alias("label"), "features"))
    params = {"n_estimators": 12, "max_depth": 4, "learning_rate": 0.3, "min_child_weight": 3}
    weighted, weight = M.weighted(df, task, "GBT")
    own = M._estimator("GBT", M.KIND[task], params, weight).fit(weighted)
    spark, jobs = df.sparkSession, df.sparkSession.sparkContext.statusTracker()
    monkeypatch.setattr(forest, "grow", None)
    monkeypatch.setattr(forest.GBTRegressor, "fit", None)
    spark.sparkContext.setJobGroup(f"one-task-{task}", "")
    mine = M.fit_one(df, task, "GBT", params)
    n_jobs = len(jobs.getJobIdsForGroup(f"one-task-{task}"))
    assert type(mine) is type(own) and n_jobs < (90 if task == "risk" else 30)  # 48 levels a booster
    out = "prediction" if task == "inventory" else "rawPrediction"
    pairs = mine.transform(own.transform(df).select("features", F.col(out).alias("theirs"))).select(out, "theirs").collect()
    a, b = (np.array([r[k] if task == "inventory" else r[k].toArray() for r in pairs]) for k in (0, 1))
    # Of equal gains rounding chooses, which the later rounds of a class then carry on.
    assert np.isclose(a, b, atol=1e-2 if task == "risk" else 1e-7).mean() > 0.98 and a.std() > 0.1


def test_drawn_rows_and_slots_of_one_task_boosting(rows, monkeypatch):
    """A part of the rows and slots a tree: another model than Spark's draws give, but as good a one."""
    monkeypatch.setattr(forest, "DENSE", 1 << 28)
    df = rows.select(F.col("y").alias("label"), "features")
    train, held = (stable(d) for d in df.randomSplit([0.7, 0.3], 3))
    params = {"n_estimators": 30, "max_depth": 5, "learning_rate": 0.1, "subsample": 0.7, "colsample_bytree": 0.8}
    mine, own = M.fit_one(train, "cost", "GBT", params), M._estimator("GBT", "regression", params, None).fit(train)
    a, b, c = (m.transform(held).agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0]
               for m in (mine, own, M.fit_one(train, "cost", "GBT", {**params, "n_estimators": 1})))
    assert a < 1.1 * b and a < 0.7 * c and mine.getNumTrees == 30
