"""Correlation, feature, scaling and encoding queries with oracles
(co*, so02, fe*, fx*, nm01, en*) and the sinks io04 and io08."""

from __future__ import annotations

from pyspark.sql import functions as F

from shipcast.operators import correlate as K
from shipcast.operators import encode as E
from shipcast.operators import features as FE
from shipcast.plans.catalog import NUMERIC, _ship, _train, r, register, rounded, union
from shipcast.plans.oracle import with_shipments
from shipcast.sources import sinks
from shipcast.sources.shipments import train_test

W = with_shipments


# ------------------------------------------------------------------ correlation

def _corr_ctes(cols):
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(cols))
    long = union([f"SELECT order_id, {i} AS i, CAST({c} AS DOUBLE) AS x FROM train" for i, c in enumerate(cols)])
    return f"""
nm AS (SELECT * FROM (VALUES {names}) t(i, name)),
cl AS ({long}),
pr AS (SELECT a.i, b.i AS j, corr(a.x, b.x) AS c FROM cl a JOIN cl b ON a.order_id = b.order_id AND a.i < b.i
       GROUP BY a.i, b.i),
pairs AS (SELECT pr.i, pr.j, n1.name AS var1, n2.name AS var2,
          CASE WHEN isnan(c) THEN NULL ELSE c END AS correlation
          FROM pr JOIN nm n1 ON n1.i = pr.i JOIN nm n2 ON n2.i = pr.j)"""


_C = _corr_ctes(NUMERIC)


_MATRIX = f"""
SELECT var1, var2, {r('correlation', 'correlation')} FROM pairs
UNION ALL SELECT var2, var1, {r('correlation', 'correlation')} FROM pairs
UNION ALL SELECT name, name, CASE WHEN v > 0 THEN 1.0 END FROM ({union(
    [f"SELECT '{c}' AS name, var_samp(CAST({c} AS DOUBLE)) AS v FROM train" for c in NUMERIC])})"""


@register("co01_corr_matrix", W(_MATRIX, ctes=_C))
def co01(spark, sf):
    return rounded(K.corr_matrix_long(_train(spark, sf), NUMERIC))


@register("co02_corr_pairs", W(f"""SELECT var1, var2, {r('correlation', 'correlation')},
 {r('abs(correlation)', 'abs_corr')} FROM pairs""", ctes=_C))
def co02(spark, sf):
    return rounded(K.corr_pairs(_train(spark, sf), NUMERIC).select("var1", "var2", "correlation", "abs_corr"))


@register("so02_topk_corr", W(f"""SELECT var1, var2, {r('correlation', 'correlation')},
 {r('abs(correlation)', 'abs_corr')} FROM pairs ORDER BY abs(correlation) DESC NULLS LAST, i, j LIMIT 15""", ctes=_C))
def so02(spark, sf):
    return rounded(K.top_pairs(_train(spark, sf), NUMERIC, k=15))


@register("co03_corr_selected", W(f"""SELECT var1, var2, {r('correlation', 'correlation')},
 {r('abs(correlation)', 'abs_corr')} FROM pairs""", ctes=_corr_ctes(K.KEY_VARIABLES)))
def co03(spark, sf):
    return rounded(K.corr_pairs(_train(spark, sf), K.KEY_VARIABLES).select("var1", "var2", "correlation", "abs_corr"))


@register("io08_sink_corr", W("SELECT var1 AS variable, " + ", ".join(
    f"max(CASE WHEN var2 = '{c}' THEN correlation END) AS {c}" for c in NUMERIC) + f" FROM ({_MATRIX}) GROUP BY var1", ctes=_C))
def io08(spark, sf):
    """The correlation matrix as CSV, read back."""
    wide = K.corr_matrix_wide(_train(spark, sf), NUMERIC)
    path = sinks.write_csv(wide, sinks.new_path(spark, "full_correlation_matrix"), partition_by=None)
    return rounded(spark.read.option("header", True).schema(wide.schema).csv(path))


# ------------------------------------------------------------------ features

def _features(spark, sf, names, round_names=(), as_double=(), extras=True):
    ship = _ship(spark, sf)
    train, _ = train_test(ship)
    state = FE.fit_feature_state(train, names)
    j = ship if state is None else ship.crossJoin(F.broadcast(state))
    fitted = [] if state is None else state.columns
    ex = {**FE.core_feature_exprs(ship), **FE.fitted_feature_exprs(ship, fitted), **FE.log_cost_exprs(ship)}
    if extras:
        ex.update(FE.extra_feature_exprs(ship, fitted))
    out = j.select("order_id", "split", *[(ex[n].cast("double") if n in as_double else ex[n]).alias(n)
                                          for n in names])
    # Only values whose last bits can differ between engines are rounded:
    # aggregates and transcendental functions.  Plain arithmetic is
    # bit-identical and is compared exactly.
    return out.select(*[(F.round(F.col(c), 6) + F.lit(0.0)).alias(c) if c in round_names else F.col(c)
                        for c in out.columns])


def _feature_query(qid, names, sql_exprs, ctes="", as_double=()):
    def one(n, e, rnd):
        e = f"CAST({e} AS DOUBLE)" if n in as_double else e
        return f"round({e}, 6) + 0.0 AS {n}" if rnd else f"{e} AS {n}"
    sel = ", ".join(one(*x) for x in sql_exprs)
    frm = "shipments" + (", st" if ctes else "")
    rn = [n for n, _, rnd in sql_exprs if rnd]
    register(qid, W(f"SELECT order_id, split, {sel} FROM {frm}", ctes=ctes))(
        lambda spark, sf: _features(spark, sf, names, rn, as_double))


M = "month(order_date)"
_FEATURES = [
    ("fe01_month_num", [("month_num", f"CAST({M} AS INTEGER)", False)]),
    ("fe02_month_cyclic", [("month_sin", f"sin(2 * pi() * {M} / 12)", True),
                           ("month_cos", f"cos(2 * pi() * {M} / 12)", True)]),
    ("fe03_is_quarter_end", [("is_quarter_end", f"CASE WHEN {M} IN (3, 6, 9, 12) THEN 1 ELSE 0 END", False)]),
    ("fe04_inv_below_safety", [("inv_below_safety",
                                "CASE WHEN current_stock_days < safety_stock_days THEN 1 ELSE 0 END", False)]),
    ("fe05_needs_reorder", [("needs_reorder",
                             "CASE WHEN reorder_point_days > current_stock_days THEN 1 ELSE 0 END", False)]),
    ("fe06_reorder_point_calc", [("reorder_point_calc",
                                  "average_daily_unit_sales * total_lead_time_days + safety_stock_days", False)]),
    ("fe07_schedule_slack", [("schedule_slack", "planned_delivery_days - total_lead_time_days", False),
                             ("under_planned",
                              "CASE WHEN planned_delivery_days - total_lead_time_days < 0 THEN 1 ELSE 0 END", False)]),
    ("fe08_cost_per_unit", [("cost_per_unit", "manufacturing_cost_per_batch / (batch_size_units + 1)", False)]),
    ("fe09_api_cost_share", [("api_cost_share",
                              "CASE WHEN api_cost_per_kg / (manufacturing_cost_per_batch + 1) IS NULL THEN NULL "
                              "ELSE greatest(least(api_cost_per_kg / (manufacturing_cost_per_batch + 1), 1.0), 0.0) END",
                              False)]),
    ("fe12_is_cold_chain", [("is_cold_chain", "CAST(cold_chain_required AS INTEGER)", False)]),
    ("fe13_log1p_costs", [(f"{c}_log", f"ln(1 + {c})", True) for c in FE.LOG_COST_COLUMNS]),
    ("fx01_calendar", [("year", "CAST(year(order_date) AS INTEGER)", False),
                       ("day_of_month", "CAST(day(order_date) AS INTEGER)", False),
                       ("is_weekend", "CASE WHEN dayofweek(order_date) IN (0, 6) THEN 1 ELSE 0 END", False)]),
    ("fx03_inv_gap", [("inv_gap", "current_stock_days - safety_stock_days", False)]),
    ("fx04_inv_utilization", [("inv_utilization",
                               "CASE WHEN safety_stock_days = 0 THEN NULL ELSE current_stock_days / safety_stock_days END",
                               False)]),
    ("fx05_reorder_gap", [("reorder_gap", "reorder_point_days - current_stock_days", False)]),
    ("fx06_schedule_buffer_ratio", [("schedule_buffer_ratio",
                                     "CASE WHEN total_lead_time_days = 0 THEN NULL ELSE "
                                     "(planned_delivery_days - total_lead_time_days) / total_lead_time_days END", False)]),
    ("fx07_packaging_total", [("packaging_total", "packaging_cost_per_unit * batch_size_units", False)]),
    ("fx08_lead_ratios", [("api_lead_ratio", "CASE WHEN total_lead_time_days = 0 THEN NULL ELSE "
                           "api_lead_time_days / total_lead_time_days END", False),
                          ("mfg_lead_ratio", "CASE WHEN total_lead_time_days = 0 THEN NULL ELSE "
                           "manufacturing_lead_time_days / total_lead_time_days END", False)]),
    ("fx09_batch_flags", [("is_large_batch", "CASE WHEN batch_size_units >= 25000 THEN 1 ELSE 0 END", False),
                          ("is_small_batch", "CASE WHEN batch_size_units <= 2500 THEN 1 ELSE 0 END", False)]),
    ("fx10_batch_size_log", [("batch_size_log", "ln(1 + batch_size_units)", True)]),
    ("fx11_combined_risk", [("combined_risk", "supplier_risk_score * (1 + stock_out_risk)", False)]),
]

for _qid, _exprs in _FEATURES:
    _feature_query(_qid, [n for n, _, _ in _exprs], _exprs)

_feature_query("fe10_quality_index", ["quality_index"], [(
    "quality_index", "(defect_rate_ppm - dm) / (ds + 1e-8) + (quality_risk_score - qm) / (qs + 1e-8)", True)],
    ctes="""st AS (SELECT avg(defect_rate_ppm) AS dm, stddev_samp(defect_rate_ppm) AS ds,
 avg(quality_risk_score) AS qm, stddev_samp(quality_risk_score) AS qs FROM train)""")

_feature_query("fe11_supplier_perf_bucket", ["supplier_perf_bucket"], [(
    "supplier_perf_bucket", "CASE WHEN supplier_historical_performance <= q25 THEN 0 "
    "WHEN supplier_historical_performance <= q50 THEN 1 WHEN supplier_historical_performance <= q75 THEN 2 "
    "WHEN supplier_historical_performance IS NOT NULL THEN 3 END", False)], as_double=("supplier_perf_bucket",),
    ctes="""st AS (SELECT quantile_cont(supplier_historical_performance, 0.25) AS q25,
 quantile_cont(supplier_historical_performance, 0.5) AS q50,
 quantile_cont(supplier_historical_performance, 0.75) AS q75 FROM train)""")

_feature_query("fx02_days_since_start", ["days_since_start"], [(
    "days_since_start", "CAST(datediff('day', st0, order_date) AS INTEGER)", False)],
    ctes="st AS (SELECT min(order_date) AS st0 FROM train)")


# ------------------------------------------------------------------ scaling / encoding

@register("nm01_standard_scale", W(
    "SELECT order_id, split, " + ", ".join(
        r(f"({c} - {c}__m) / (CASE WHEN {c}__s = 0 OR {c}__s IS NULL THEN 1 ELSE {c}__s END)", c) for c in NUMERIC)
    + " FROM shipments, (SELECT " + ", ".join(f"avg({c}) AS {c}__m, stddev_pop({c}) AS {c}__s" for c in NUMERIC)
    + " FROM train) st"))
def nm01(spark, sf):
    ship = _ship(spark, sf)
    train, _ = train_test(ship)
    return rounded(E.apply_scaler(ship, E.fit_scaler(train, NUMERIC)).select("order_id", "split", *NUMERIC))


ONE_HOT_COLUMNS = [c for c in E.CATEGORICAL if c in (
    "product_category", "formulation", "temperature_requirement", "manufacturing_site", "distribution_center",
    "api_supplier", "shipping_mode", "market_region", "day_of_week", "quarter")]


def _vocab_sql(cols, source):
    return union([f"SELECT '{c}' AS col, val, row_number() OVER (ORDER BY val) AS rk FROM "
                  f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS val FROM {source} WHERE {c} IS NOT NULL)" for c in cols])


@register("en01_one_hot", W(union([
    f"SELECT s.order_id, s.split, v.col || '_' || v.val AS feature FROM shipments s "
    f"JOIN v ON v.col = '{c}' AND CAST(s.{c} AS VARCHAR) = v.val WHERE v.rk > 1" for c in ONE_HOT_COLUMNS]),
    ctes=f"v AS ({_vocab_sql(ONE_HOT_COLUMNS, 'train')})"))
def en01(spark, sf):
    ship = _ship(spark, sf)
    train, _ = train_test(ship)
    return E.one_hot_long(train, ship, ONE_HOT_COLUMNS, ["order_id", "split"])


EN02_COLUMNS = ("product_category", "formulation", "manufacturing_site", "distribution_center")


@register("en02_align_columns", W(union([
    f"SELECT s.order_id, vt.col || '_' || vt.val AS feature FROM test s "
    f"JOIN vt ON vt.col = '{c}' AND CAST(s.{c} AS VARCHAR) = vt.val AND vt.rk > 1 "
    f"JOIN vtr ON vtr.col = vt.col AND vtr.val = vt.val AND vtr.rk > 1" for c in EN02_COLUMNS]),
    ctes=f"vt AS ({_vocab_sql(EN02_COLUMNS, 'test')}), vtr AS ({_vocab_sql(EN02_COLUMNS, 'train')})"))
def en02(spark, sf):
    """Each split encoded with its own vocabulary (the reference's per-split
    ``get_dummies``), then test aligned to train's columns."""
    ship = _ship(spark, sf)
    train, test = train_test(ship)
    cols = list(EN02_COLUMNS)
    own = E.one_hot_long(test, test, cols, ["order_id"])
    # Aligned to train's columns: a feature that train lacks is dropped.
    named = E.vocabulary(train, cols).select(F.concat_ws("_", "col", "val").alias("feature"))
    return own.join(named, "feature", "left_semi").select("order_id", "feature")


@register("en03_label_encode", W("""SELECT order_id, CASE supply_chain_disruption_risk WHEN 'Low_Risk' THEN 0
 WHEN 'Medium_Risk' THEN 1 WHEN 'High_Risk' THEN 2 END AS label, supply_chain_disruption_risk AS decoded FROM shipments"""))
def en03(spark, sf):
    df = E.encode_labels(_ship(spark, sf))
    return E.decode_labels(df, "label", "decoded").select("order_id", "label", "decoded")


# ------------------------------------------------------------------ sinks (rows-only)

@register("io04_sink_csv_raw", W("SELECT * FROM shipments"))
def io04(spark, sf):
    """Both splits as CSV, read back with the order table's types."""
    ship = _ship(spark, sf)
    train, test = train_test(ship)
    path = sinks.write_splits_csv(train, test, sinks.new_path(spark, "raw_splits"))
    return spark.read.option("header", True).schema(ship.schema).csv(path).select(ship.columns)
