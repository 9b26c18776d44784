"""Oversampling, search and task runs on small frames with a planted signal."""

import contextlib
import io
import json
import threading
import time

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from shipcast.operators import models as M
from shipcast.operators import boosting, oversample, search
from shipcast.operators.boosting import SoftmaxBoosting, SoftmaxBoostingModel
from shipcast.operators.oversample import smote
from shipcast.operators.split import kfold
from shipcast.sources.tables import load_parquet_splits


def vectors(df, *cols):
    return M.assemble(df, list(cols))[0].drop(*cols)


def test_smote_draws_base_rows_uniformly(spark):
    """A class uniform on [0, 1), a tenth as many synthetic rows: their mean stays near one half."""
    df = (spark.range(1000).select(F.lit(0).alias("label"), (F.col("id") / 1000).alias("x"), F.lit(1.0).alias("y"))
          .unionByName(spark.range(1100).select(F.lit(1).alias("label"), F.lit(5.0).alias("x"), F.lit(0.0).alias("y"))))
    out = smote(vectors(df, "x", "y"), "label")
    made = np.array([r.features.toArray() for r in out.where("is_synthetic = 1").collect()])
    assert len(made) == 100 and abs(made[:, 0].mean() - 0.5) < 0.1 and (made[:, 0] >= 0).all() and (made[:, 0] < 1).all()
    assert (made[:, 1] == 1).all() and out.where("label = 1").count() == 1100


def mixed_rows(n, seed):
    """Clustered numeric columns and one-hot slots, as sparse vectors, with repeated rows."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, 4)) * 6
    numeric = centre[rng.integers(0, 12, n)] + rng.normal(size=(n, 4))
    hot = np.zeros((n, 40))
    hot[np.arange(n), rng.integers(0, 40, n)] = 1
    rows = np.hstack([numeric, hot])
    rows[-20:] = rows[:20]
    return rows


def sparse(row):
    at = np.flatnonzero(row)
    return Vectors.sparse(len(row), at.tolist(), row[at].tolist())


@pytest.mark.parametrize("pivots, block", [(64, 1024), (9, 100)])
def test_neighbours_equal_brute_force(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(oversample, "PIVOTS", pivots)
    monkeypatch.setattr(oversample, "BLOCK", block)
    rows = mixed_rows(2000, 7)
    df = spark.createDataFrame([("a" if k % 4 else "b", k // 4 if k % 4 == 0 else k - k // 4 - 1,
                                 sparse(r) if k % 3 else Vectors.dense(r)) for k, r in enumerate(rows)],
                               oversample.T.StructType([
                                   oversample.T.StructField("cls", oversample.T.StringType()),
                                   oversample.T.StructField("r", oversample.T.LongType()),
                                   oversample.T.StructField("v", VectorUDT())]))
    asked = df.select("cls", "r").where("r % 2 = 0")
    found = oversample.neighbours(df, asked, 5)
    got = {}
    for r in found.collect():
        got.setdefault((r["cls"], r["base"]), {})[r["at"]] = (r["d"], r["r"])
    classes = {"b": rows[::4], "a": np.delete(rows, np.s_[::4], 0)}
    assert len(got) == asked.count()
    for (c, base), near in got.items():
        x = classes[c]
        d = np.sqrt(((x - x[base]) ** 2).sum(1))
        d[base] = np.inf
        want = np.sort(d)[:5]
        assert sorted(near) == [1, 2, 3, 4, 5] and len({r for _, r in near.values()}) == 5
        assert np.allclose([near[k][0] for k in range(1, 6)], want, atol=1e-9)
        assert np.allclose([d[near[k][1]] for k in range(1, 6)], want, atol=1e-9)


def test_neighbours_of_sparse_rows_take_no_memory_for_empty_slots(spark):
    """Rows of two billion slots, of which a row holds three: the neighbours of the same rows in 42 slots."""
    rng, size = np.random.default_rng(5), 2_000_000_000
    x, hot = rng.normal(size=(300, 2)), rng.integers(0, 40, 300)
    rows = [("a", i, Vectors.sparse(size, [0, 1, 7 + 40_000_000 * int(h)], [*map(float, p), 1.0])) for i, (p, h) in enumerate(zip(x, hot))]
    df = spark.createDataFrame(rows, ["cls", "r", "v"])
    found = oversample.neighbours(df, df.select("cls", "r").where("r % 3 = 0"), 5)
    got = {}
    for r in found.orderBy("base", "at").collect():
        got.setdefault(r["base"], []).append(r["r"])
    flat = np.hstack([x, np.eye(40)[hot]])
    d = np.sqrt(((flat[:, None] - flat[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert got == {i: [int(j) for j in np.lexsort((np.arange(300), d[i]))[:5]] for i in range(0, 300, 3)}


def test_neighbours_join_by_cells_only(spark):
    plan = io.StringIO()
    df = spark.createDataFrame([(0, sparse(r)) for r in mixed_rows(50, 1)] + [(1, sparse(r)) for r in mixed_rows(80, 2)],
                               ["label", "features"])
    with contextlib.redirect_stdout(plan):
        smote(df, "label").explain()
    assert "CartesianProduct" not in plan.getvalue() and "NestedLoop" not in plan.getvalue()


def test_smote_rows_lie_between_neighbours_in_every_slot(spark):
    minority, majority = mixed_rows(60, 3), mixed_rows(100, 4)
    df = spark.createDataFrame([(0, 3, sparse(r)) for r in minority] + [(1, 4, sparse(r)) for r in majority],
                               ["label", "fold", "features"])
    out = smote(df.repartition(4), "label", carry=["fold"])
    made = [r for r in out.where("is_synthetic = 1").collect()]
    assert len(made) == 40 and {r["fold"] for r in made} == {3}
    distance = np.sqrt(((minority[:, None] - minority[None]) ** 2).sum(2))
    np.fill_diagonal(distance, np.inf)
    reach = np.sort(distance, 1)[:, 4]

    def between(p):
        for i in range(len(minority)):
            for j in np.flatnonzero(distance[i] <= reach[i]):
                step = minority[j] - minority[i]
                if not step.any():
                    if np.abs(minority[i] - p).max() < 1e-9:
                        return True
                    continue
                u = (p - minority[i]) @ step / (step @ step)
                if -1e-9 <= u <= 1 and np.abs(minority[i] + u * step - p).max() < 1e-9:
                    return True
        return False

    assert all(between(r["features"].toArray()) for r in made)
    again = smote(df.repartition(7), "label", carry=["fold"]).where("is_synthetic = 1").collect()
    assert sorted(map(str, again)) == sorted(map(str, made))


def test_smote_tiny_classes(spark):
    rows = [(0, 1.0)] + [(1, 2.0), (1, 3.0)] + [(2, float(k)) for k in range(10)]
    out = smote(vectors(spark.createDataFrame(rows, "label int, x double"), "x"), "label").collect()
    by = {}
    for r in out:
        by.setdefault(r.label, []).append(r.features[0])
    assert {c: len(v) for c, v in by.items()} == {0: 10, 1: 10, 2: 10}
    assert set(by[0]) == {1.0} and all(2 <= x <= 3 for x in by[1])


def signal(spark, task, n=400):
    df = spark.range(n).select(F.col("id").alias("order_id"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("a"),
                               (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000).alias("b"))
    label = {"binary": F.col("a") > 0.6, "multiclass": F.floor(F.col("a") * 2.999), "regression": 10 * F.col("a") + F.col("b")}
    df = kfold(df.withColumn("label", label[M.KIND[task]].cast("double")), None)
    return M.assemble(df, ["a", "b"])[0].select("label", "fold", "features")


@pytest.mark.parametrize("task, family, grid", [
    ("delay", "Logistic", {"C": [0.1, 10]}),
    ("cost", "RandomForest", {"n_estimators": [10], "max_depth": [4, 6]}),
    ("inventory", "GBT", {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.1, 0.3]})])
def test_search_beats_the_constant(spark, task, family, grid):
    df = signal(spark, task)
    model, params, best, table = search.random_search(df, task, family, n_iter=5, grid=grid)
    assert len(table) == 2 and params in [d for _, d, _ in table] and best in [s for _, _, s in table]
    larger = search.SCORES[task]().isLargerBetter()
    constant = {"binary": 0.5, "multiclass": 0.4, "regression": 3.0}[M.KIND[task]]
    assert best > constant if larger else best < constant
    assert model.transform(df).count() == 400


def test_search_scores_equal_a_plain_loop_and_trials_are_read_again(spark, tmp_path, monkeypatch):
    """Balancing inside the folds included; the second search fits nothing but the refit.  A
    forest's samples depend on how its rows are stored, so the learner here is the logistic one."""
    df = signal(spark, "delay", 240)
    grid, balance = {"C": [0.0005, 10]}, lambda d: d.unionByName(d.where("label = 1"))
    trials = search.Trials(spark, f"{tmp_path}/trials")
    model, params, best, table = search.random_search(df, "delay", "Logistic", n_iter=2, grid=grid, balance=balance,
                                                      trials=trials)
    for number, draw, score in table:
        plain = []
        for k in range(M.N_FOLDS):
            fitted = M.fit_one(balance(df.where(f"fold <> {k}").select("label", "features")), "delay", "Logistic", draw)
            plain.append(search.HardLabelAUC().evaluate(fitted.transform(df.where(f"fold = {k}"))))
        assert abs(sum(plain) / len(plain) - score) < 1e-9
    rows = trials.table().collect()
    assert len(rows) == 10 and {(r["draw"], r["fold"]) for r in rows} == {(d, k) for d in range(2) for k in range(5)}
    means = {}
    for r in rows:
        means.setdefault(r["params"], []).append(r["score"])
    top = max(means, key=lambda p: sum(means[p]))
    assert json.loads(top) == params and abs(sum(means[top]) / 5 - best) < 1e-9
    fits = []
    fit_one = M.fit_one
    monkeypatch.setattr(M, "fit_one", lambda *a: fits.append(a[3]) or fit_one(*a))
    again = search.random_search(df, "delay", "Logistic", n_iter=2, grid=grid, balance=balance, trials=trials)
    assert fits == [params] and again[1] == params and abs(again[2] - best) < 1e-9
    assert [(i, d) for i, d, _ in again[3]] == [(i, d) for i, d, _ in table]


def test_logistic_folds_are_fitted_at_once_and_trees_one_fold_after_the_other(spark, monkeypatch):
    class Constant(search.Model):
        def _transform(self, dataset):
            return dataset.withColumn("prediction", F.lit(1.0))

    meet, folds = threading.Barrier(2 * M.N_FOLDS), []
    monkeypatch.setattr(M, "fit_one", lambda *a: (meet.wait(60), Constant())[1])
    df, draws = signal(spark, "delay", 60), [{"C": 1}, {"C": 2}]
    learner = search.TaskLearner("delay", "Logistic", draws)
    scores = search.cross_validate(df, learner, search.HardLabelAUC(), [0, 1], 2)
    assert scores == {0: 0.5, 1: 0.5}
    monkeypatch.setattr(M, "fit_one", lambda rows, *a: (folds.append(rows.count()), time.sleep(1), folds.append(0), Constant())[3])
    search.cross_validate(df, search.TaskLearner("delay", "RandomForest", draws), search.HardLabelAUC(), [0], 4)
    assert folds == [48, 0] * M.N_FOLDS
    with pytest.raises(ValueError, match="folds"):
        search.cross_validate(df.where("fold < 4"), learner, search.HardLabelAUC(), [0], 1)


def test_logistic_fits_do_not_carry_the_names_of_slots(spark, monkeypatch):
    seen, df = [], signal(spark, "delay")
    assert df.schema["features"].metadata

    class Noted(M.LogisticRegression):
        def fit(self, rows, params=None):
            seen.append(rows.schema["features"].metadata)
            return super().fit(rows, params)

    plain = M.fit_one(df, "delay", "Logistic", {"C": 1})
    monkeypatch.setattr(M, "LogisticRegression", Noted)
    fitted = M.fit_one(df, "delay", "Logistic", {"C": 1})
    assert seen == [{}] and np.allclose(fitted.coefficients.toArray(), plain.coefficients.toArray())


@pytest.mark.parametrize("evaluator, rows, value, larger", [
    (search.WeightedF1, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 2.0)], (2 * 2 / 3 + 2 / 3 + 1) / 4, True),
    (search.HardLabelAUC, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)], 0.75, True),
    (search.RMSE, [(1.0, 3.0), (2.0, 2.0)], 2 ** 0.5, False),
    (search.BusinessCost, [(1.0, 3.0), (5.0, 2.0)], (2 + 9) / 2, False)])
def test_evaluators(spark, tmp_path, evaluator, rows, value, larger):
    df = spark.createDataFrame(rows, "y double, p double")
    made = evaluator(labelCol="y", predictionCol="p")
    assert abs(made.evaluate(df) - value) < 1e-12 and made.isLargerBetter() == larger
    made.write().overwrite().save(f"{tmp_path}/e")
    assert abs(evaluator.load(f"{tmp_path}/e").evaluate(df) - value) < 1e-12


def test_loader_gives_nothing_for_a_missing_path(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    assert load_parquet_splits(spark, f"{tmp_path}/a", f"{tmp_path}/none") == (None, None)
    train, test = load_parquet_splits(spark, f"{tmp_path}/a", f"{tmp_path}/a")
    assert train.count() == test.count() == 3


def test_assembling_a_null_is_an_error(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0)], "order_id long, a double, b double")
    with pytest.raises(Exception, match="null|NaN"):
        M.assemble(df, ["a", "b"])[0].collect()


def planted_classes(spark, n=2000):
    """Three classes: two bands of one column and what lies outside them, with some labels turned round."""
    rng = np.random.default_rng(8)
    x = rng.uniform(-3, 3, size=(n, 3))
    label = np.where(np.abs(x[:, 0]) < 1, 0, np.where(x[:, 1] > 0, 1, 2))
    flip = rng.random(n) < 0.1
    label[flip] = rng.integers(0, 3, flip.sum())
    return spark.createDataFrame([(int(k), Vectors.dense(r)) for k, r in zip(label, x)], ["label", "features"]).repartition(3)


def test_softmax_boosting(spark, tmp_path, monkeypatch):
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    from pyspark.ml.functions import vector_to_array
    from shipcast.operators import metrics as MT
    rows = planted_classes(spark)
    train, held = rows.randomSplit([0.7, 0.3], 3)
    options = dict(maxIter=6, maxDepth=3, stepSize=0.3)
    other = SoftmaxBoosting(**options).fit(train)
    monkeypatch.setattr(boosting, "CUT", 1)  # the loss of every round
    model = SoftmaxBoosting(**options).fit(train)
    assert len(model.losses) == 6 and other.losses == pytest.approx(model.losses[-1:]) and all(a > b for a, b in zip(model.losses, model.losses[1:])) and model.losses[0] < np.log(3)
    out = model.transform(held)
    assert set(out.columns) == {"label", "features", "probability", "prediction"}
    for r in out.collect():
        p = r.probability.toArray()
        assert abs(p.sum() - 1) < 1e-12 and (p >= 0).all() and r.prediction == p.argmax()
    # The margins of the ensemble are those of training.
    own = model.transform(train).select(vector_to_array("probability").alias("p"), "label")
    loss = own.agg(F.avg(-F.log(F.element_at("p", F.col("label").cast("int") + 1)))).first()[0]
    assert abs(loss - model.losses[-1]) < 1e-9
    rest = OneVsRest(classifier=GBTClassifier(seed=42, **options)).fit(train)
    f1 = [MT.f1_weighted(m.transform(held)).first()["f1_weighted"] for m in (model, rest)]
    assert f1[0] >= f1[1] and f1[0] > 0.85
    model.save(str(tmp_path / "m"))
    again = SoftmaxBoostingModel.load(str(tmp_path / "m"))
    key = lambda df: sorted((tuple(r.features), tuple(r.probability), r.prediction) for r in df.collect())
    assert key(again.transform(held)) == key(out) and again.losses == model.losses
    assert [r[2] for r in key(other.transform(held))] == [r[2] for r in key(out)]


def test_softmax_boosting_small_inputs(spark):
    one = spark.createDataFrame([(0, Vectors.dense([float(k)])) for k in range(5)], ["label", "features"])
    out = SoftmaxBoosting(maxIter=3, maxDepth=2).fit(one).transform(one).collect()
    assert {r.prediction for r in out} == {0.0} and len(out) == 5
    gap = spark.createDataFrame([(2 * (k % 2), Vectors.dense([float(k % 2)])) for k in range(20)], ["label", "features"])
    model = SoftmaxBoosting(maxIter=3, maxDepth=2, stepSize=0.5).fit(gap)
    assert [(r.label, r.prediction) for r in model.transform(gap).distinct().orderBy("label").collect()] == [(0, 0.0), (2, 2.0)]
    with pytest.raises(ValueError):
        SoftmaxBoosting().fit(one.where("1 = 0"))


def test_the_softmax_query_draws_from_the_references_lists(monkeypatch):
    """As many rounds as the list of the other boosters asks for, where five were fixed."""
    import __spark_entry__ as entry
    from shipcast.plans import tasks
    seen = []
    for name, made in (("prepare", (None, None, None)), ("folder", ""), ("exists", False)):
        monkeypatch.setattr(tasks, name, lambda *a, made=made: made)

    class Rows(dict):
        select = lambda self, *a: self

    monkeypatch.setattr(M, "assemble", lambda *a: (Rows(), []))
    monkeypatch.setattr(M, "fit_one", lambda rows, *a: seen.append(a))
    monkeypatch.setattr(M, "score", lambda *a: None)
    monkeypatch.setattr(tasks.sinks, "save_model", lambda *a: None)

    class Spark:
        range = lambda self, n: self
        write = property(lambda self: self)
        mode = lambda self, m: self
        parquet = lambda self, p: None

    entry.queries()["ml09_softmax_gbt"](Spark(), "-")
    assert seen == [("risk", "SoftmaxGBT", M.draw_params(M.GRIDS["risk"]["GBT"], 1)[0])]
    assert seen[0][2]["n_estimators"] >= 100 and seen[0][2]["max_depth"] >= 6


def test_a_search_leaves_no_balanced_rows_behind(spark):
    """Oversampled folds and what their neighbours were found with are deleted once they are fitted."""
    import os
    from shipcast.session import scratch_path
    folder = os.path.dirname(scratch_path(spark, "x").removeprefix("file:"))
    os.makedirs(folder, exist_ok=True)
    df = search.stable_alone(lambda: signal(spark, "risk", 200).where("label < 2 or hash(label, features) % 2 = 0"))
    before = set(os.listdir(folder))
    model, *_ = search.random_search(df, "risk", "RandomForest", n_iter=2, grid={"n_estimators": [2, 3], "max_depth": [2]},
                                     balance=lambda rows: smote(rows, "label").drop("is_synthetic"))
    assert model.transform(df).count() == df.count() and set(os.listdir(folder)) == before
