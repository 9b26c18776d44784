"""Split, weight, metric and selection queries with oracles (ml01-ml04,
ml06, ml14-ml18, jn02), and the rows-only model queries."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.operators import baseline as B
from shipcast.operators import clean as C
from shipcast.operators import encode as E
from shipcast.operators import metrics as MT
from shipcast.operators import split as S
from shipcast.operators.quantiles import stable
from shipcast.plans.catalog import NUMERIC, _ship, _train, r, register, rounded
from shipcast.plans.oracle import with_shipments
from shipcast.plans.queries_features import _FEATURES, ONE_HOT_COLUMNS, _vocab_sql
from shipcast.sources.shipments import train_test

W = with_shipments

_ORDER = "md5(CAST(order_id AS VARCHAR)), order_id"


def _rank_sql(label=None, extra=""):
    part = f"PARTITION BY {label} " if label else ""
    return (f"SELECT order_id{extra}, row_number() OVER ({part}ORDER BY {_ORDER}) - 1 AS rk, "
            f"count(*) OVER ({part.strip()}) AS n FROM train")


@register("ml01_split_random", W(f"""SELECT order_id, CASE WHEN rk < ceil(CAST(0.2 AS DOUBLE) * n) THEN 1 ELSE 0 END AS is_val
FROM ({_rank_sql()})"""))
def ml01(spark, sf):
    return S.holdout(_train(spark, sf).select("order_id")).select("order_id", "is_val")


@register("ml02_split_stratified", W(f"""SELECT order_id, will_be_delayed,
 CASE WHEN rk < ceil(CAST(0.2 AS DOUBLE) * n) THEN 1 ELSE 0 END AS is_val
FROM ({_rank_sql('will_be_delayed', ', will_be_delayed')})"""))
def ml02(spark, sf):
    df = _train(spark, sf).select("order_id", "will_be_delayed")
    return S.holdout(df, "will_be_delayed").select("order_id", "will_be_delayed", "is_val")


@register("ml03_kfold", W(f"SELECT order_id, CAST(rk % 5 AS INTEGER) AS fold FROM ({_rank_sql()})"))
def ml03(spark, sf):
    return S.kfold(_train(spark, sf).select("order_id")).select("order_id", "fold")


@register("ml04_stratified_kfold", W(f"""SELECT order_id, supply_chain_disruption_risk, CAST(rk % 5 AS INTEGER) AS fold
FROM ({_rank_sql('supply_chain_disruption_risk', ', supply_chain_disruption_risk')})"""))
def ml04(spark, sf):
    df = _train(spark, sf).select("order_id", "supply_chain_disruption_risk")
    return S.kfold(df, "supply_chain_disruption_risk").select("order_id", "supply_chain_disruption_risk", "fold")


@register("ml06_class_weight", W(f"""SELECT will_be_delayed, count(*) AS n_class,
 {r('CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*))', 'balanced_weight')},
 {r('CAST(sum(count(*) FILTER (WHERE will_be_delayed = 0)) OVER () AS DOUBLE) / sum(count(*) FILTER (WHERE will_be_delayed = 1)) OVER ()', 'pos_weight')}
FROM train WHERE will_be_delayed IS NOT NULL GROUP BY will_be_delayed"""))
def ml06(spark, sf):
    return rounded(S.class_weights(_train(spark, sf), "will_be_delayed"))


@register("ml06_class_weight_multiclass", W(f"""SELECT supply_chain_disruption_risk, count(*) AS n_class,
 {r('CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*))', 'balanced_weight')}
FROM train WHERE supply_chain_disruption_risk IS NOT NULL GROUP BY supply_chain_disruption_risk"""))
def ml06m(spark, sf):
    return rounded(S.class_weights(_train(spark, sf), "supply_chain_disruption_risk"))


@register("jn02_label_align", W("""SELECT f.order_id, f.api_cost_per_kg, f.total_lead_time_days, l.supply_chain_disruption_risk
FROM (SELECT order_id, api_cost_per_kg, total_lead_time_days FROM train) f
JOIN (SELECT order_id, supply_chain_disruption_risk FROM train) l USING (order_id)"""))
def jn02(spark, sf):
    """Features and labels re-attached by key (not by row position)."""
    train = _train(spark, sf)
    feats = train.select("order_id", "api_cost_per_kg", "total_lead_time_days")
    labels = train.select("order_id", "supply_chain_disruption_risk")
    return feats.join(labels, "order_id")


# ------------------------------------------------------------------ metrics

_RISK_CODE = ("CASE supply_chain_disruption_risk WHEN 'Low_Risk' THEN 0 WHEN 'Medium_Risk' THEN 1 "
              "WHEN 'High_Risk' THEN 2 END")


def _noisy_risk(spark, sf):
    """Risk labels with a deterministic prediction that is wrong for every
    fourth order (next class), over the test split."""
    test = train_test(_ship(spark, sf))[1]
    df = E.encode_labels(test.select("order_id", "supply_chain_disruption_risk"))
    pred = F.when(F.col("order_id") % 4 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    return df.select("order_id", "label", pred.alias("prediction"))


@register("ml14_metric_f1_weighted", W(f"""
SELECT {r('sum(CASE WHEN sup + prd > 0 THEN 2.0 * tp / (sup + prd) ELSE 0 END * sup) / sum(sup)', 'f1_weighted')},
 CAST(sum(sup) AS BIGINT) AS n FROM per""", ctes=f"""
lp AS (SELECT {_RISK_CODE} AS y, CASE WHEN order_id % 4 = 0 THEN ({_RISK_CODE} + 1) % 3 ELSE {_RISK_CODE} END AS p FROM test),
c AS (SELECT y AS k FROM lp UNION SELECT p FROM lp),
per AS (SELECT k, (SELECT count(*) FROM lp WHERE y = k) AS sup, (SELECT count(*) FROM lp WHERE p = k) AS prd,
               (SELECT count(*) FROM lp WHERE y = k AND p = k) AS tp FROM c)"""))
def ml14(spark, sf):
    return rounded(MT.f1_weighted(_noisy_risk(spark, sf)))


def _baseline_scored(spark, sf, label, keys):
    ship = _ship(spark, sf)
    train, test = train_test(ship)
    state = B.fit_group_mean(train, label, keys)
    scored = B.predict_group_mean(test.where(F.col(label).isNotNull()), state, keys)
    return scored.select(F.col(label).alias("label"), "prediction", *keys)


def _baseline_sql(label, keys, source="test"):
    if not keys:
        return (f"SELECT t.{label} AS y, g.m AS p FROM {source} t, (SELECT avg({label}) AS m FROM train) g "
                f"WHERE t.{label} IS NOT NULL")
    kl = ", ".join(keys)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    on = " AND ".join(f"t.{k} = k.{k}" for k in keys)
    return (f"SELECT t.{label} AS y, coalesce(k.m, g.m) AS p FROM {source} t "
            f"LEFT JOIN (SELECT {kl}, avg({label}) AS m FROM train WHERE {nn} GROUP BY {kl}) k ON {on} "
            f"CROSS JOIN (SELECT avg({label}) AS m FROM train) g WHERE t.{label} IS NOT NULL")


@register("ml15_metric_regression", W(f"""SELECT count(*) AS n, {r('sqrt(avg((y - p) * (y - p)))', 'rmse')},
 {r('avg(abs(y - p))', 'mae')}, {r('avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100', 'mape')},
 {r('1 - sum((y - p) * (y - p)) / sum((y - ybar) * (y - ybar))', 'r2')}
FROM (SELECT *, avg(y) OVER () AS ybar FROM ({_baseline_sql('realistic_total_cost', ['product_category'])}))"""))
def ml15(spark, sf):
    return rounded(MT.regression_metrics(_baseline_scored(spark, sf, "realistic_total_cost", ["product_category"])))


@register("ml16_metric_auc", W(f"""
SELECT CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(q) AS BIGINT) AS n_neg,
 {r('CAST(sum(p * (qb + 0.5 * q)) AS DOUBLE) / (sum(p) * sum(q))', 'auc')} FROM c""", ctes="""
g AS (SELECT total_lead_time_days AS s, count(*) FILTER (WHERE will_be_delayed = 1) AS p,
             count(*) FILTER (WHERE will_be_delayed = 0) AS q FROM test WHERE total_lead_time_days IS NOT NULL GROUP BY 1),
c AS (SELECT p, q, coalesce(sum(q) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS qb FROM g)"""))
def ml16(spark, sf):
    test = train_test(_ship(spark, sf))[1].where(F.col("total_lead_time_days").isNotNull())
    return rounded(MT.auc(test, "will_be_delayed", "total_lead_time_days"))


@register("ml16_metric_auc_hard_label", W(f"""SELECT {r('''(CAST(count(*) FILTER (WHERE will_be_delayed = 1 AND total_lead_time_days > 60) AS DOUBLE)
   / count(*) FILTER (WHERE will_be_delayed = 1)
 + CAST(count(*) FILTER (WHERE will_be_delayed = 0 AND total_lead_time_days <= 60) AS DOUBLE)
   / count(*) FILTER (WHERE will_be_delayed = 0)) / 2''', 'auc_hard_label')}
FROM test WHERE total_lead_time_days IS NOT NULL"""))
def ml16h(spark, sf):
    test = train_test(_ship(spark, sf))[1].where(F.col("total_lead_time_days").isNotNull())
    scored = test.select("will_be_delayed", (F.col("total_lead_time_days") > 60).cast("int").alias("prediction"))
    return rounded(MT.hard_label_auc(scored, "will_be_delayed", "prediction"))


@register("ml17_metric_business_cost", W(f"""SELECT count(*) AS n, {r('sqrt(avg((y - p) * (y - p)))', 'rmse')},
 {r('avg(abs(y - p))', 'mae')},
 {r('avg(1.0 * greatest(p - y, 0.0) + 3.0 * greatest(y - p, 0.0))', 'business_cost')}
FROM ({_baseline_sql('optimal_stock_days', ['product_category'])})"""))
def ml17(spark, sf):
    return rounded(MT.business_cost(_baseline_scored(spark, sf, "optimal_stock_days", ["product_category"])))


CANDIDATES = (("global_mean", ()), ("category_mean", ("product_category",)),
              ("product_mean", ("product_category", "formulation")))


@register("ml18_select_best", W(f"""
SELECT model, seq, {r('rmse', 'rmse')},
 CASE WHEN row_number() OVER (ORDER BY rmse, seq) = 1 THEN 1 ELSE 0 END AS is_best FROM m""", ctes=f"""
m AS ({' UNION ALL '.join(
    f"SELECT '{name}' AS model, {i} AS seq, sqrt(avg((y - p) * (y - p))) AS rmse FROM ({_baseline_sql('realistic_total_cost', list(keys))})"
    for i, (name, keys) in enumerate(CANDIDATES))})"""))
def ml18(spark, sf):
    from shipcast.operators.models import select_best
    parts = []
    for i, (name, keys) in enumerate(CANDIDATES):
        m = MT.regression_metrics(_baseline_scored(spark, sf, "realistic_total_cost", list(keys)))
        parts.append(m.select(F.lit(name).alias("model"), F.lit(i).alias("seq"), "rmse"))
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    return rounded(select_best(table, "rmse", minimize=True).select("model", "seq", "rmse", "is_best"))


# ------------------------------------------------------------------ the pipeline in SQL

_NEGATIVE = "CASE WHEN actual_delivery_days < 0 THEN NULL ELSE actual_delivery_days END"
PP01_FEATURES = [(n, e) for q, exprs in _FEATURES if q.startswith("fe") and q != "fe13_log1p_costs" for n, e, _ in exprs]
_LOGS = [(n, e) for q, exprs in _FEATURES if q == "fe13_log1p_costs" for n, e, _ in exprs]
PP01_NUMERIC = [*NUMERIC, *[n for n, _ in PP01_FEATURES], "quality_index", "supplier_perf_bucket", *[n for n, _ in _LOGS]]


def _pipeline_ctes():
    """raw orders -> p6 (all columns, scaled) in SQL, step by step as the pipeline does."""
    win = [c for c in C.WINSOR_COLUMNS if c in NUMERIC]
    bounds = ", ".join(f"quantile_cont({c}, {p}) AS {c}_p{k}" for c in win for p, k in ((0.01, "01"), (0.99, "99")))
    clip = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, {c}_p99), {c}_p01) END AS {c}" for c in win)
    drop = ", ".join(f"{c}_p{k}" for c in win for k in ("01", "99"))
    out = [f"p0 AS (SELECT * REPLACE ({_NEGATIVE} AS actual_delivery_days) FROM shipments)",
           f"p1 AS (SELECT * EXCLUDE ({drop}) REPLACE ({clip}) FROM p0, (SELECT {bounds} FROM p0 WHERE split = 'train') b)"]
    at = "p1"
    for spec, (keys, cols) in C.IMPUTE_SPECS.items():
        cols = [c for c in cols if c in NUMERIC]
        med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}__m" for c in cols)
        on, known = " AND ".join(f"s.{k} = g.{k}" for k in keys), " AND ".join(f"{k} IS NOT NULL" for k in keys)
        fill = {c: f"coalesce(g.{c}__m, a.{c}__m)" if spec == "category" else
                f"CASE WHEN g.{keys[0]} IS NOT NULL THEN g.{c}__m ELSE a.{c}__m END" for c in cols}
        out.append(f"{spec}_fill AS (SELECT s.* REPLACE ({', '.join(f'coalesce(s.{c}, {fill[c]}) AS {c}' for c in cols)}) FROM {at} s "
                   f"LEFT JOIN (SELECT {', '.join(keys)}, {med} FROM {at} WHERE split = 'train' AND {known} GROUP BY {', '.join(keys)}) g "
                   f"ON {on} CROSS JOIN (SELECT {med} FROM {at} WHERE split = 'train') a)")
        at = f"{spec}_fill"
    med = ", ".join(f"quantile_cont({c}, 0.5) AS {c}__m, count(*) FILTER ({c} IS NULL) AS {c}__k" for c in NUMERIC)
    gone = ", ".join(f"{c}__m, {c}__k" for c in NUMERIC)
    fill = ", ".join(f"CAST(CASE WHEN {c}__k > 0 THEN coalesce({c}, {c}__m) ELSE {c} END AS DOUBLE) AS {c}" for c in NUMERIC)
    out.append(f"p4 AS (SELECT * EXCLUDE ({gone}) REPLACE ({fill}) FROM {at}, (SELECT {med} FROM {at} WHERE split = 'train') f)")
    x = "supplier_historical_performance"
    made = [*PP01_FEATURES, *_LOGS,
            ("quality_index", "(defect_rate_ppm - dm) / (ds + 1e-8) + (quality_risk_score - qm) / (qs + 1e-8)"),
            ("supplier_perf_bucket", f"CASE WHEN {x} <= q25 THEN 0 WHEN {x} <= q50 THEN 1 WHEN {x} <= q75 THEN 2 "
                                     f"WHEN {x} IS NOT NULL THEN 3 END")]
    out.append(f"""p5 AS (SELECT p4.*, {', '.join(f'{e} AS {n}' for n, e in made)} FROM p4, (
SELECT avg(defect_rate_ppm) AS dm, stddev_samp(defect_rate_ppm) AS ds, avg(quality_risk_score) AS qm, stddev_samp(quality_risk_score) AS qs,
 quantile_cont({x}, 0.25) AS q25, quantile_cont({x}, 0.5) AS q50, quantile_cont({x}, 0.75) AS q75 FROM p4 WHERE split = 'train') st)""")
    scaled = ", ".join(r(f"({c} - {c}__m) / (CASE WHEN {c}__s = 0 OR {c}__s IS NULL THEN 1 ELSE {c}__s END)", c) for c in PP01_NUMERIC)
    moments = ", ".join(f"avg({c}) AS {c}__m, stddev_pop({c}) AS {c}__s" for c in PP01_NUMERIC)
    out.append(f"p6 AS (SELECT order_id, split, order_date, supply_chain_disruption_risk, {', '.join(ONE_HOT_COLUMNS)}, {scaled} "
               f"FROM p5, (SELECT {moments} FROM p5 WHERE split = 'train') st)")
    # Slots run from the last value to the second; the first value has none.
    out.append(f"v AS ({_vocab_sql(ONE_HOT_COLUMNS, 'train')})")
    out += [f"v_{c} AS (SELECT val, CAST(CASE WHEN rk = 1 THEN 0 ELSE max(rk) OVER () - rk + 1 END AS INTEGER) AS slot "
            f"FROM v WHERE col = '{c}')" for c in ONE_HOT_COLUMNS]
    return ",\n".join(out)


_SLOTS = ", ".join(f"coalesce(v_{c}.slot, 0) AS {c}_slot" for c in ONE_HOT_COLUMNS)
_SLOT_JOINS = " ".join(f"LEFT JOIN v_{c} ON v_{c}.val = CAST(p6.{c} AS VARCHAR)" for c in ONE_HOT_COLUMNS)
PP01_SQL = W(f"""SELECT order_id, split, order_date, supply_chain_disruption_risk, {', '.join(PP01_NUMERIC)}, {_SLOTS}
FROM p6 {_SLOT_JOINS}""", ctes=_pipeline_ctes())
NULLS_SQL = W("SELECT split, count(*) AS n_rows, CAST(sum(" + " + ".join(
    f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in ("order_date", "supply_chain_disruption_risk", *PP01_NUMERIC))
    + " + CASE WHEN order_date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_cells FROM p6 GROUP BY split", ctes=_pipeline_ctes())
ML22_SQL = W(f"""SELECT order_id, CAST((SELECT count(*) FROM v WHERE rk > 1) AS INTEGER) AS n_slots,
 {' + '.join(f'CASE WHEN coalesce(v_{c}.slot, 0) > 0 THEN 1 ELSE 0 END' for c in ONE_HOT_COLUMNS)} AS n_filled
FROM p6 {_SLOT_JOINS} WHERE split = 'train'""", ctes=_pipeline_ctes())


# ------------------------------------------------------------------ models (rows-only)
# Fits depend on the learner's randomness and floating point, so they are checked
# by row count and schema only.  ml07-ml12 fit one parameter set drawn from the
# reference's list on the processed train split and score the test split; the
# task runs search, select and refit, and every report reads their results.

TASKS = ("risk", "cost", "delay", "inventory")


def _run(spark, sf, task):
    """The task's run over the reference's lists: all families, as many draws as the reference makes."""
    from shipcast.plans.tasks import run_task
    return run_task(spark, sf, task)


def _runs(spark, sf):
    """(task, run) of all four tasks, which are run at once: a search is a chain of jobs, most of
    them too small for all cores."""
    _ship(spark, sf)  # the order table, which all of them read, is written once
    with ThreadPool(len(TASKS)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda task: (task, _run(spark, sf, task))), TASKS, chunksize=1)


def _family_query(task, family):
    def fn(spark, sf):
        from shipcast.operators import models as M
        from shipcast.plans.tasks import fitted, prepare
        _, test, cols = prepare(spark, sf, task)
        return M.score(fitted(spark, sf, task, family), M.assemble(test, cols)[0], task)
    return fn


for _qid, _task, _fam in (("ml07_rf_classifier", "risk", "RandomForest"),
                          ("ml08_rf_regressor", "cost", "RandomForest"),
                          ("ml09_gbt_multiclass", "risk", "GBT"),
                          ("ml09_softmax_gbt", "risk", "SoftmaxGBT"),
                          ("ml10_gbt_binary", "delay", "GBT"),
                          ("ml11_gbt_regressor", "inventory", "GBT"),
                          ("ml12_logistic", "delay", "Logistic")):
    register(_qid)(_family_query(_task, _fam))


@register("pp01_run_pipeline", PP01_SQL)
def pp01(spark, sf):
    """All processed rows; every one-hot vector as the number of its slot (0: none)."""
    from shipcast.functions.columns import vector_cells
    from shipcast.plans.preprocess import run_pipeline
    out = run_pipeline(_ship(spark, sf), "all")
    hot = [F.coalesce(F.get(vector_cells(f"{c}_vec"), F.lit(0))["slot"], F.lit(0)).alias(f"{c}_slot") for c in ONE_HOT_COLUMNS]
    return rounded(out.select("order_id", "split", "order_date", "supply_chain_disruption_risk", *PP01_NUMERIC, *hot))


@register("ml05_smote")
def ml05(spark, sf):
    """Risk classes of the train split grown to the majority size, over all processed columns:
    every vector as its number of slots and the map of those that are not zero (slot from 1 -> value)."""
    from shipcast.functions.columns import vector_cells, vector_size
    from shipcast.operators import models as M
    from shipcast.operators.oversample import smote
    from shipcast.plans.tasks import prepare
    train, _, cols = prepare(spark, sf, "risk")
    out = smote(stable(M.assemble(train, cols)[0].select("label", "features")), "label")
    return out.withColumns({"n_slots": vector_size("features"), "features": F.map_from_entries(vector_cells("features"))})


@register("ml05_smote_class_counts", W("""SELECT CASE supply_chain_disruption_risk WHEN 'Low_Risk' THEN 0
 WHEN 'Medium_Risk' THEN 1 WHEN 'High_Risk' THEN 2 END AS label, count(*) AS n_rows,
 max(count(*)) OVER () - count(*) AS n_synthetic FROM train GROUP BY 1"""))
def ml05_counts(spark, sf):
    """Rows and synthetic rows of each class after oversampling."""
    return ml05(spark, sf).groupBy("label").agg(F.count_if(F.col("is_synthetic") == 0).alias("n_rows"),
                                                F.count_if(F.col("is_synthetic") == 1).alias("n_synthetic"))


@register("ml20_refit_full")
def ml20(spark, sf):
    """Test predictions of the cost task's best draw, refit on all train rows."""
    return _run(spark, sf, "cost").predictions()


@register("ml21_score")
def ml21(spark, sf):
    """Test predictions of the risk task's selected model, as (order_id, class name)."""
    return _run(spark, sf, "risk").predictions()


@register("jn03_id_align")
def jn03(spark, sf):
    """Predictions keep the key carried through transform (no positional join)."""
    return _run(spark, sf, "inventory").predictions()


@register("jn03_id_align_keys", W("SELECT order_id, 1 AS n_predictions FROM test"))
def jn03_keys(spark, sf):
    """Every test order has one prediction under its own key."""
    return jn03(spark, sf).groupBy("order_id").agg(F.count("prediction").cast("int").alias("n_predictions"))


def _prediction_stats(p):
    from shipcast.operators.quantiles import quantiles_wide
    # The median uses the rank-based quantile: no single task holds the column.
    med = quantiles_wide(p, ["prediction"], [0.5], names={("prediction", 0.5): "median"})
    s = p.agg(F.avg("prediction").alias("mean"), F.min("prediction").alias("min"),
              F.max("prediction").alias("max"))
    return s.crossJoin(med).select("mean", "median", "min", "max")


@register("ag25_prediction_stats")
def ag25(spark, sf):
    return _prediction_stats(_run(spark, sf, "cost").predictions())


@register("ag25_prediction_stats_baseline", W(f"""SELECT {r('avg(p)', 'mean')}, {r('quantile_cont(p, 0.5)', 'median')},
 {r('min(p)', 'min')}, {r('max(p)', 'max')} FROM ({_baseline_sql('realistic_total_cost', ['product_category'])})"""))
def ag25_baseline(spark, sf):
    """The same statistics of the group-mean predictor, which SQL can make too."""
    return rounded(_prediction_stats(_baseline_scored(spark, sf, "realistic_total_cost", ["product_category"])))


@register("ag27_delay_class_share")
def ag27_delay(spark, sf):
    """Predicted classes of the selected delay model."""
    p = _run(spark, sf, "delay").predictions()
    return p.groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).crossJoin(p.agg(F.count("*").alias("n_orders")))


@register("ag27_prediction_class_share")
def ag27(spark, sf):
    """Predicted classes of the selected risk and delay models."""
    parts = None
    for task in ("risk", "delay"):
        p = _run(spark, sf, task).predictions().groupBy(F.col("prediction").cast("string").alias("prediction")).agg(
            F.count(F.lit(1)).alias("n"))
        total = p.agg(F.sum("n").alias("total"))
        p = p.crossJoin(total).select(F.lit(task).alias("task"), "prediction", "n", (F.col("n") / F.col("total")).alias("share"))
        parts = p if parts is None else parts.unionByName(p)
    return parts


@register("ag27_delayed_share_and_spend")
def ag27_delay_spend(spark, sf):
    """Share of orders predicted delayed, and total predicted spend, over the test orders."""
    late = _run(spark, sf, "delay").predictions().agg(F.avg("prediction").alias("delayed_share"))
    spend = _run(spark, sf, "cost").predictions().agg(F.sum("prediction").alias("total_spend"))
    return late.crossJoin(spend)  # one row each


@register("cl01_repair_count", W("SELECT count(*) FILTER (actual_delivery_days < 0) AS n_fixed FROM train"))
def cl01_count(spark, sf):
    from shipcast.operators.clean import count_repairs
    return count_repairs(_train(spark, sf))


@register("pp01_null_report", NULLS_SQL)
def pp01_nulls(spark, sf):
    from shipcast.plans.preprocess import null_report, run_pipeline
    return null_report(run_pipeline(_ship(spark, sf), "all"))


@register("fx12_overstock_flag_baseline", W(f"""SELECT count(*) FILTER (stock > p) AS n_overstocked, count(*) AS n_orders
FROM ({_baseline_sql('optimal_stock_days', ['product_category']).replace(' AS y,', ' AS y, t.current_stock_days AS stock,')})"""))
def fx12_baseline(spark, sf):
    """Overstocked orders against the group-mean predictor, which SQL can make too."""
    from shipcast.operators.features import overstock_flag
    train, test = train_test(_ship(spark, sf))
    state = B.fit_group_mean(train, "optimal_stock_days", ["product_category"])
    scored = B.predict_group_mean(test.where(F.col("optimal_stock_days").isNotNull()), state, ["product_category"])
    return overstock_flag(scored).agg(F.count_if(F.col("overstocked") == 1).alias("n_overstocked"),
                                      F.count(F.lit(1)).alias("n_orders"))


@register("ag27_predicted_spend_baseline", W(f"""SELECT {r('sum(p)', 'total_spend', 2)}, count(*) AS n_orders
FROM ({_baseline_sql('realistic_total_cost', ['product_category'])})"""))
def ag27_baseline(spark, sf):
    """Total predicted spend of the group-mean predictor."""
    scored = _baseline_scored(spark, sf, "realistic_total_cost", ["product_category"])
    return rounded(scored.agg(F.sum("prediction").alias("total_spend"), F.count(F.lit(1)).alias("n_orders")), 2)


@register("fx12_overstock_flag")
def fx12(spark, sf):
    from shipcast.operators.features import overstock_flag
    preds = _run(spark, sf, "inventory").predictions()
    test = train_test(_ship(spark, sf))[1].select("order_id", "current_stock_days")
    return overstock_flag(test.join(preds, "order_id")).agg(
        F.sum("overstocked").alias("n_overstocked"), F.count(F.lit(1)).alias("n_orders"))


@register("io09_sink_predictions")
def io09(spark, sf):
    """The four prediction files, read back: task, order_id, prediction."""
    from shipcast.sources import sinks
    out = None
    for task, run in _runs(spark, sf):
        path = sinks.write_predictions(run.predictions(), sinks.new_path(spark, f"prediction_task_{task}"))
        rows = spark.read.option("header", True).csv(path).withColumn("task", F.lit(task))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("io10_sink_metrics")
def io10(spark, sf):
    """The metrics document of every task, as it stands in its file."""
    out = None
    for task, run in _runs(spark, sf):
        rows = run.document().select(
            "task", "best_model", F.to_json("best_params").alias("best_params"), F.to_json("results").alias("results"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("io11_save_model")
def io11(spark, sf):
    """The saved inventory pipeline, loaded, on raw test orders: order_id, prediction."""
    raw = _ship(spark, sf).where(F.col("split") == "test").drop("optimal_stock_days")
    return _run(spark, sf, "inventory").model().transform(raw).select("order_id", "prediction")


@register("ml22_assemble", ML22_SQL)
def ml22(spark, sf):
    """Processed columns of the train orders as one vector each: its size, and how many slots are not zero."""
    from shipcast.functions.columns import vector_cells, vector_size
    from shipcast.operators import models as M
    from shipcast.plans.preprocess import run_pipeline
    out = run_pipeline(_ship(spark, sf), "all").where(F.col("split") == "train")
    hot = [f"{c}_vec" for c in ONE_HOT_COLUMNS]
    return M.assemble(out.select("order_id", *hot), hot)[0].select(
        "order_id", vector_size("features").alias("n_slots"), F.size(vector_cells("features")).alias("n_filled"))


@register("io06_sink_processed")
def io06(spark, sf):
    """Processed train and test rows of all four tasks, written as CSV and read back:
    one row per task, split and column."""
    from shipcast.plans.tasks import preprocessing
    from shipcast.sources import sinks

    @inheritable_thread_target(spark)
    def one(task):
        fitted, processed = preprocessing(spark, sf, task)
        path = sinks.write_processed(processed, E.feature_names(fitted.stages, spark), sinks.new_path(spark, f"processed_{task}"))
        back = sinks.read_processed(spark, path, processed.schema)
        return back.groupBy("split").agg(F.count("*").alias("n_rows"),
                                         F.count_distinct("order_id").alias("n_orders")).withColumn("task", F.lit(task))

    with ThreadPool(len(TASKS)) as pool:  # the preparation, which is made once, is done for the first
        return reduce(DataFrame.unionByName, pool.map(one, TASKS, chunksize=1))


@register("ml13_random_search")
def ml13(spark, sf):
    """The trial table of all four task runs: one row per task, family, draw and fold."""
    out = None
    for task, run in _runs(spark, sf):
        rows = run.trials.table().withColumn("task", F.lit(task))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("ml23_task_run")
def ml23(spark, sf):
    """All four tasks: every family's scores, and which one was selected."""
    out = None
    for task, run in _runs(spark, sf):
        rows = run.metrics().select(
            F.lit(task).alias("task"), "model", "cv_metric", F.to_json("params").alias("params"),
            F.to_json("metrics").alias("metrics"), "is_best")
        out = rows if out is None else out.unionByName(rows)
    return out
