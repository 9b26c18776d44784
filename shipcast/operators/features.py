"""Feature derivation: column expressions (fe01-fe13, fx01-fx11).

All features are Catalyst expressions in one projection, so they run inside
the scan's whole-stage-codegen span.  The three features that need train
statistics (quality index, supplier bucket, days since start) take a one-row
state DataFrame that is broadcast-cross-joined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.functions.columns import clip, flag
from shipcast.operators.quantiles import quantiles_wide

# Fixed values of the feature formulas.
QUARTER_END_MONTHS = (3, 6, 9, 12)
Z_EPS = 1e-8
LOG_COST_COLUMNS = ("api_cost_per_kg", "excipient_cost_per_kg", "packaging_cost_per_unit",
                    "manufacturing_cost_per_batch")
LARGE_BATCH, SMALL_BATCH = 25000, 2500


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(None)).otherwise(a / b)


def core_feature_exprs(df: DataFrame) -> dict[str, Column]:
    """fe01-fe09, fe12: features that need no fitted state."""
    c = F.col
    out: dict[str, Column] = {}
    if _has(df, "order_date"):
        m = F.month("order_date")
        out["month_num"] = m
        ang = F.lit(2 * math.pi) * m / 12
        out["month_sin"] = F.sin(ang)
        out["month_cos"] = F.cos(ang)
        out["is_quarter_end"] = flag(m.isin(*QUARTER_END_MONTHS))
    if _has(df, "current_stock_days", "safety_stock_days"):
        out["inv_below_safety"] = flag(c("current_stock_days") < c("safety_stock_days"))
    if _has(df, "reorder_point_days", "current_stock_days"):
        out["needs_reorder"] = flag(c("reorder_point_days") > c("current_stock_days"))
    if _has(df, "average_daily_unit_sales", "total_lead_time_days", "safety_stock_days"):
        out["reorder_point_calc"] = (c("average_daily_unit_sales") * c("total_lead_time_days")
                                     + c("safety_stock_days"))
    if _has(df, "planned_delivery_days", "total_lead_time_days"):
        slack = c("planned_delivery_days") - c("total_lead_time_days")
        out["schedule_slack"] = slack
        out["under_planned"] = flag(slack < 0)
    if _has(df, "batch_size_units", "manufacturing_cost_per_batch"):
        out["cost_per_unit"] = c("manufacturing_cost_per_batch") / (c("batch_size_units") + 1)
    if _has(df, "api_cost_per_kg", "manufacturing_cost_per_batch"):
        share = c("api_cost_per_kg") / (c("manufacturing_cost_per_batch") + 1)
        out["api_cost_share"] = clip(share, F.lit(0.0), F.lit(1.0))
    if _has(df, "cold_chain_required"):
        out["is_cold_chain"] = c("cold_chain_required").cast("int")
    return out


def fit_feature_state(train: DataFrame, names: Sequence[str] | None = None) -> DataFrame | None:
    """One row of the train statistics that the features ``names`` (default: all)
    need: z-score mean/std (sample) of defect rate and quality score,
    supplier-performance quartiles, first order date.  None if they need none."""
    def wanted(name: str, *cols: str) -> bool:
        return (names is None or name in names) and _has(train, *cols)

    aggs = []
    if wanted("quality_index", "defect_rate_ppm", "quality_risk_score"):
        aggs += [F.avg("defect_rate_ppm").alias("_d_mean"), F.stddev_samp("defect_rate_ppm").alias("_d_std"),
                 F.avg("quality_risk_score").alias("_q_mean"), F.stddev_samp("quality_risk_score").alias("_q_std")]
    if wanted("days_since_start", "order_date"):
        aggs.append(F.min("order_date").alias("_start"))
    state = train.agg(*aggs) if aggs else None
    c = "supplier_historical_performance"
    if wanted("supplier_perf_bucket", c):
        qs = quantiles_wide(train, [c], [0.25, 0.5, 0.75],
                            names={(c, 0.25): "_q25", (c, 0.5): "_q50", (c, 0.75): "_q75"})
        state = qs if state is None else state.crossJoin(qs)
    return state


def fitted_feature_exprs(df: DataFrame, state_cols: list[str]) -> dict[str, Column]:
    """fe10, fe11 and fx02 against the joined one-row state."""
    c = F.col
    out: dict[str, Column] = {}
    if "_d_mean" in state_cols and _has(df, "defect_rate_ppm", "quality_risk_score"):
        dz = (c("defect_rate_ppm") - c("_d_mean")) / (c("_d_std") + Z_EPS)
        qz = (c("quality_risk_score") - c("_q_mean")) / (c("_q_std") + Z_EPS)
        out["quality_index"] = dz + qz
    if "_q25" in state_cols and _has(df, "supplier_historical_performance"):
        x = c("supplier_historical_performance")
        out["supplier_perf_bucket"] = (F.when(x <= c("_q25"), 0).when(x <= c("_q50"), 1)
                                       .when(x <= c("_q75"), 2).when(x.isNotNull(), 3))
    return out


def extra_feature_exprs(df: DataFrame, state_cols: list[str]) -> dict[str, Column]:
    """fx01-fx11: features named in the dashboard text."""
    c = F.col
    out: dict[str, Column] = {}
    if _has(df, "order_date"):
        out["year"] = F.year("order_date")
        out["day_of_month"] = F.dayofmonth("order_date")
        out["is_weekend"] = flag(F.dayofweek("order_date").isin(1, 7))
        if "_start" in state_cols:
            out["days_since_start"] = F.datediff(c("order_date"), c("_start"))
    if _has(df, "current_stock_days", "safety_stock_days"):
        out["inv_gap"] = c("current_stock_days") - c("safety_stock_days")
        out["inv_utilization"] = _safe_div(c("current_stock_days"), c("safety_stock_days"))
    if _has(df, "reorder_point_days", "current_stock_days"):
        out["reorder_gap"] = c("reorder_point_days") - c("current_stock_days")
    if _has(df, "planned_delivery_days", "total_lead_time_days"):
        out["schedule_buffer_ratio"] = _safe_div(c("planned_delivery_days") - c("total_lead_time_days"),
                                                 c("total_lead_time_days"))
    if _has(df, "packaging_cost_per_unit", "batch_size_units"):
        out["packaging_total"] = c("packaging_cost_per_unit") * c("batch_size_units")
    if _has(df, "total_lead_time_days"):
        if _has(df, "api_lead_time_days"):
            out["api_lead_ratio"] = _safe_div(c("api_lead_time_days"), c("total_lead_time_days"))
        if _has(df, "manufacturing_lead_time_days"):
            out["mfg_lead_ratio"] = _safe_div(c("manufacturing_lead_time_days"), c("total_lead_time_days"))
    if _has(df, "batch_size_units"):
        out["is_large_batch"] = flag(c("batch_size_units") >= LARGE_BATCH)
        out["is_small_batch"] = flag(c("batch_size_units") <= SMALL_BATCH)
        out["batch_size_log"] = F.log1p("batch_size_units")
    if _has(df, "supplier_risk_score", "stock_out_risk"):
        out["combined_risk"] = c("supplier_risk_score") * (1 + c("stock_out_risk"))
    return out


def log_cost_exprs(df: DataFrame, cols=LOG_COST_COLUMNS) -> dict[str, Column]:
    """fe13: ``{c}_log = log1p(c)``."""
    return {f"{c}_log": F.log1p(c) for c in cols if c in df.columns}


def engineer(df: DataFrame, train: DataFrame, extras: bool = False) -> DataFrame:
    """The pipeline's feature step: fe01-fe12 (and fx01-fx11 with ``extras``),
    train-fitted where a statistic is needed.  Existing columns are kept."""
    return engineer_with(df, fit_feature_state(train), extras)


def engineer_with(df: DataFrame, state: DataFrame | None, extras: bool = False) -> DataFrame:
    """The feature step with a fitted state (``fit_feature_state``)."""
    j = df if state is None else df.crossJoin(F.broadcast(state))
    fitted = [] if state is None else state.columns
    feats = core_feature_exprs(df)
    feats.update(fitted_feature_exprs(df, fitted))
    if extras:
        feats.update(extra_feature_exprs(df, fitted))
    keep = [F.col(c) for c in df.columns if c not in feats]
    return j.select(*keep, *[e.alias(n) for n, e in feats.items()])


def overstock_flag(scored: DataFrame, stock_col: str = "current_stock_days",
                   pred_col: str = "prediction") -> DataFrame:
    """fx12: an order is overstocked when its stock days exceed the predicted
    optimal stock days."""
    return scored.withColumn("overstocked", flag(F.col(stock_col) > F.col(pred_col)))
