"""Fitted stages, processed files and whole task runs on the smallest tables."""

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array

from conftest import SF_SMALL
from shipcast.operators import encode as E
from shipcast.operators import models as M
from shipcast.operators import search as S
from shipcast.operators import stages
from shipcast.plans import tasks
from shipcast.sources import sinks
from shipcast.sources.shipments import shipments_table

GRID = {"RandomForest": {"n_estimators": [4], "max_depth": [2, 5], "max_features": ["sqrt"]}}


@pytest.fixture(scope="module")
def run(spark):
    return tasks.run_task(spark, SF_SMALL, "inventory", GRID, 2)


def test_loaded_stages_process_raw_orders_as_the_fitted_ones(spark, tmp_path):
    ship = shipments_table(spark, SF_SMALL)
    fitted = stages.fit_preprocessing(ship.where("split = 'train'"), "delay")
    fitted.write().overwrite().save(f"{tmp_path}/stages")
    loaded = PipelineModel.load(f"{tmp_path}/stages")
    assert [s.uid for s in loaded.stages] == [s.uid for s in fitted.stages]
    one, two = fitted.transform(ship).orderBy("order_id").collect(), loaded.transform(ship).orderBy("order_id").collect()
    assert one == two and len(one) == ship.count()
    assert "will_be_delayed" not in one[0].asDict() and "product_category_vec" in one[0].asDict()


def test_the_saved_model_scores_raw_orders_as_the_run_did(spark, run):
    raw = shipments_table(spark, SF_SMALL).where("split = 'test'").drop("optimal_stock_days")
    got = {r["order_id"]: r["prediction"] for r in run.model().transform(raw).select("order_id", "prediction").collect()}
    want = {r["order_id"]: r["prediction"] for r in run.predictions().collect()}
    assert got == want and len(got) == raw.count()


def test_the_refit_has_the_best_row_of_the_trial_table(spark, run):
    means = {}
    for r in run.trials.table().collect():
        means.setdefault((r["family"], r["params"]), []).append(r["score"])
    assert {len(v) for v in means.values()} == {M.N_FOLDS} and len(means) == 2
    (family, params), scores = min(means.items(), key=lambda x: sum(x[1]))
    row = run.document().first()
    assert row["best_model"] == family
    assert row["best_params"] == {k: str(v) for k, v in json.loads(params).items()}
    assert abs(row["results"][family]["cv_metric"] - sum(scores) / M.N_FOLDS) < 1e-9
    assert run.model().stages[-1].getMaxDepth() == json.loads(params)["max_depth"]
    # refit on all train rows: the same fit gives the same predictions
    train, test, cols = tasks.prepare(spark, SF_SMALL, "inventory")
    again = tasks.refit(train, cols, "inventory", family, json.loads(params))
    got = {r[0]: r[1] for r in M.score(again, M.assemble(test, cols)[0], "inventory").collect()}
    assert np.allclose([got[r["order_id"]] for r in run.predictions().collect()],
                       [r["prediction"] for r in run.predictions().collect()])


def test_a_whole_run_is_read_and_a_broken_one_goes_on_from_its_trials(spark, run, monkeypatch):
    def no_fit(*args):
        raise AssertionError("fitted again")

    monkeypatch.setattr(M, "fit_one", no_fit)
    assert tasks.run_task(spark, SF_SMALL, "inventory", GRID, 2).path == run.path
    table = {r["model"]: r for r in run.metrics().collect()}
    assert table["RandomForest"]["is_best"] == 1 and table["RandomForest"]["metrics"]["business_cost"] > 0


def test_processed_rows_come_back_from_csv(spark, tmp_path):
    fitted, processed = tasks.preprocessing(spark, SF_SMALL, "inventory")
    names = E.feature_names(fitted.stages, spark)
    path = sinks.write_processed(processed, names, f"{tmp_path}/processed")
    back = sinks.read_processed(spark, path, processed.schema)
    vectors = [c for c in processed.columns if c.endswith("_vec")]
    plain = [c for c in processed.columns if c not in vectors]
    one, two = (df.select(plain).orderBy("order_id").collect() for df in (processed, back))
    assert [tuple(r) for r in one] == [tuple(r) for r in two]
    cells = {r["order_id"]: r for r in back.select("order_id", *vectors).collect()}
    for r in processed.select("order_id", *[vector_to_array(c).alias(c) for c in vectors]).collect():
        for c in vectors:
            assert cells[r["order_id"]][c] == {k + 1: v for k, v in enumerate(r[c]) if v}
    read = {(r["column"], int(r["slot"])): r["name"] for r in spark.read.option("header", True).csv(f"{path}/names").collect()}
    raw = {r["order_id"]: r["product_category"] for r in shipments_table(spark, SF_SMALL).collect()}
    for i, r in list(cells.items())[:200]:
        assert all(read["product_category_vec", k] == raw[i] for k in r["product_category_vec"])
    assert back.groupBy("split").count().count() == 2


def test_inputs_in_another_state_have_another_folder(spark, tmp_path, monkeypatch):
    first = tasks.folder(spark, SF_SMALL, "x", 1)
    monkeypatch.setattr(tasks, "input_state", lambda *a: (("changed", 1),))
    assert tasks.folder(spark, SF_SMALL, "x", 1) != first


def test_placing_rows_ranks_keys_and_labels_alone(spark, monkeypatch):
    train, _, cols = tasks.prepare(spark, SF_SMALL, "delay")
    split = tasks.SP.holdout(train.select("order_id", "label", cols[0]), "label")
    want = {r[0]: r[1] for r in tasks.SP.kfold(split.where("is_val = 0"), "label").select("order_id", "fold").collect()}
    want |= {r[0]: None for r in split.where("is_val = 1").select("order_id").collect()}
    ranked, rank_rows = [], tasks.SP.rank_rows
    monkeypatch.setattr(tasks.SP, "rank_rows", lambda df, *a: ranked.append(set(df.columns)) or rank_rows(df, *a))
    out = tasks.placed(train, "label")
    assert {r[0]: r[1] for r in out.select("order_id", "fold").collect()} == want and len(want) == train.count()
    assert ranked and all(c <= {"order_id", "label", "is_val"} for c in ranked) and set(cols) <= set(out.columns)


def test_folds_of_trees_run_at_once(spark):
    import threading
    import time
    now, most, lock = [0], [0], threading.Lock()

    class Learner:
        family, draw = "RandomForest", "draw"

        def fitMultiple(self, rows, maps):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(1)
            with lock:
                now[0] -= 1
            return S._Each(lambda i: self, len(maps))

        def transform(self, rows):
            return rows

    class Score:
        def evaluate(self, rows):
            return rows.first()["fold"]

    rows = spark.range(10).selectExpr("0.0 label", "0.0 features", "int(id % 5) fold")
    assert S.cross_validate(rows, Learner(), Score(), [0], 1) == {0: 2.0}
    assert most[0] == S.TREE_FOLDS > 1


def test_the_four_tasks_run_at_once(monkeypatch, spark):
    import threading
    from shipcast.plans import queries_ml as Q
    met = threading.Barrier(4, timeout=60)  # breaks if one task waits for another
    monkeypatch.setattr(Q, "_ship", lambda spark, sf: None)
    monkeypatch.setattr(Q, "_run", lambda spark, sf, task: met.wait() and task or task)
    assert Q._runs(spark, "-") == [(t, t) for t in ("risk", "cost", "delay", "inventory")]


def test_registered_runs_search_all_the_references_lists(monkeypatch):
    """No list of their own, and no number of draws: every family, and as many draws as the reference makes."""
    from shipcast.plans import queries_ml as Q
    asked = []
    monkeypatch.setattr(tasks, "run_task", lambda spark, sf, task, grids=None, n_iter=None: asked.append(
        (task, grids or M.GRIDS[task], n_iter or M.N_ITER[task])))
    for task in ("risk", "cost", "delay", "inventory"):
        Q._run(None, "-", task)
    assert asked == [(t, M.GRIDS[t], M.N_ITER[t]) for t in M.GRIDS] and M.N_ITER == {"risk": 2, "cost": 5, "delay": 5, "inventory": 5}
    assert all(set(g) >= {"RandomForest", "GBT"} for _, g, _ in asked)
    for _, grids, n in asked:
        for family, grid in grids.items():
            draws = M.draw_params(grid, n)
            assert len(draws) == n or family == "Logistic" and len(draws) == 4  # all that there are
            assert family == "Logistic" or min(d["n_estimators"] for d in draws) >= 100


def test_tasks_share_one_preparation_and_get_their_own_rows(spark, monkeypatch):
    fits, fit = [], stages.fit_preprocessing
    monkeypatch.setattr(tasks, "fit_preprocessing", lambda train, *task: fits.append(task) or fit(train, *task))
    made = {t: tasks.preprocessing(spark, SF_SMALL, t) for t in ("cost", "delay")}
    assert fits in ([], [()])  # for all tasks at once, unless an earlier test made it
    ship = shipments_table(spark, SF_SMALL)
    alone = fit(ship.where("split = 'train'"), "delay").transform(ship)
    fitted, processed = made["delay"]
    want = alone.orderBy("order_id").collect()
    assert processed.dtypes == alone.dtypes and processed.orderBy("order_id").collect() == want
    assert fitted.transform(ship).orderBy("order_id").collect() == want
    assert "will_be_delayed" in made["cost"][1].columns and "realistic_total_cost" not in made["cost"][1].columns
