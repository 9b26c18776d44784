"""Registry of operator queries and their SQL oracles.

Each query takes ``(spark, sf_dir)``, builds the ``shipments`` order table
from the driver tables and runs one operator over all of it.  Doubles are
rounded to a fixed number of decimals on both sides, because the two engines
sum in different orders and may differ in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6

# The shipments columns by family (train side, split removed).
SHIP_COLUMNS = (
    "order_id", "order_date", "order_timestamp", "quarter", "day_of_week", "product_category",
    "formulation", "temperature_requirement", "manufacturing_site", "distribution_center",
    "market_region", "shipping_mode", "api_supplier", "cold_chain_required", "gmp_compliant",
    "fda_approved", "ema_approved", "serialization_required", "track_trace_compliant",
    "api_cost_per_kg", "excipient_cost_per_kg", "packaging_cost_per_unit",
    "manufacturing_cost_per_batch", "total_cost_per_batch", "realistic_total_cost",
    "batch_size_units", "batch_release_time_hours", "api_lead_time_days",
    "manufacturing_lead_time_days", "total_lead_time_days", "planned_delivery_days",
    "actual_delivery_days", "will_be_delayed", "current_stock_days", "safety_stock_days",
    "reorder_point_days", "average_daily_unit_sales", "defect_rate_ppm", "quality_risk_score",
    "supplier_risk_score", "stock_out_risk", "supplier_historical_performance",
    "supply_chain_disruption_risk", "optimal_stock_days")
NUMERIC = (
    "cold_chain_required", "gmp_compliant", "fda_approved", "ema_approved",
    "serialization_required", "track_trace_compliant", "api_cost_per_kg", "excipient_cost_per_kg",
    "packaging_cost_per_unit", "manufacturing_cost_per_batch", "total_cost_per_batch",
    "realistic_total_cost", "batch_size_units", "batch_release_time_hours", "api_lead_time_days",
    "manufacturing_lead_time_days", "total_lead_time_days", "planned_delivery_days",
    "actual_delivery_days", "will_be_delayed", "current_stock_days", "safety_stock_days",
    "reorder_point_days", "average_daily_unit_sales", "defect_rate_ppm", "quality_risk_score",
    "supplier_risk_score", "stock_out_risk", "supplier_historical_performance", "optimal_stock_days")
STRINGS = ("quarter", "day_of_week", "product_category", "formulation", "temperature_requirement",
           "manufacturing_site", "distribution_center", "market_region", "shipping_mode",
           "api_supplier", "supply_chain_disruption_risk")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (reporting precision of the oracle check)."""
    # "+ 0.0" turns a rounded -0.0 into 0.0 in both engines.
    return df.select(*[(F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _ship(spark, sf):
    """The order table (written once per application, then scanned)."""
    from shipcast.sources.shipments import shipments_table
    return shipments_table(spark, sf)


def _train(spark, sf):
    from shipcast.sources.shipments import train_test
    return train_test(_ship(spark, sf))[0]


# ------------------------------------------------------------- SQL helpers

def q(name: str) -> str:
    return f'"{name}"'


def r(expr: str, alias: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {alias}"


def pct2_sql(k: str, n: str) -> str:
    return f"CAST((({k}) * 20000 + ({n})) // (2 * ({n})) AS DOUBLE) / 100"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def long_sql(cols, value_expr: str = "CAST({c} AS DOUBLE)", source: str = "train",
             value: str = "x", extra: str = "") -> str:
    return union([f"SELECT {extra}'{c}' AS \"column\", {value_expr.format(c=c)} AS {value} FROM {source}"
                  for c in cols])


# Importing the query modules fills the registry.
# Order matters only for reading: SQL-checked profile, cleaning and feature
# queries first, model fits (slowest, rows-only) last.
from shipcast.plans import queries_profile  # noqa: E402,F401,I001
from shipcast.plans import queries_clean  # noqa: E402,F401
from shipcast.plans import queries_features  # noqa: E402,F401
from shipcast.plans import queries_ml  # noqa: E402,F401
