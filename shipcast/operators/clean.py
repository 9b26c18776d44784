"""Cleaning operators: leakage drop, repair, winsorizing, median imputation.

Each fitted step is a pair ``fit_*(train) -> state DataFrame`` and
``apply_*(df, state) -> DataFrame``.  Statistics come from train only and are
applied to both splits.  State is a DataFrame, never collected:

* one-row state (global medians, winsor bounds) joins with a broadcast cross
  join, one row being a proven size bound;
* per-group state (medians per route, product or category) joins on its keys
  with a left equi-join and no hint.  AQE measures the state after it is
  built and broadcasts it when small; a large key space falls back to a
  shuffle join instead of an oversized broadcast.  NULL keys never match,
  so they fall to the global median, like a missing dictionary key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.functions.columns import clip, numeric_columns, present
from shipcast.operators.quantiles import (group_and_global_medians, medians, multi_group_medians, stable,
                                         quantiles_wide)

KEY = "order_id"

# What the leakage step drops (reference names).
ALWAYS_DROP = ("order_id", "risk_description", "batch_id", "supply_chain_complexity")
TASK_DROPS = {
    "risk": ("supply_chain_disruption_risk",),
    "cost": ("realistic_total_cost", "total_cost_per_batch"),
    "delay": ("will_be_delayed", "on_time_delivery", "actual_delivery_days"),
    "inventory": ("optimal_stock_days",),
}
TASKS = ("all", "risk", "cost", "delay", "inventory")

WINSOR_COLUMNS = ("api_cost_per_kg", "excipient_cost_per_kg", "packaging_cost_per_unit",
                  "manufacturing_cost_per_batch", "defect_rate_ppm", "batch_release_time_hours")
WINSOR_LOWER, WINSOR_UPPER = 0.01, 0.99

LEAD_COLUMNS = ("api_lead_time_days", "excipient_lead_time_days", "packaging_lead_time_days",
                "manufacturing_lead_time_days", "total_lead_time_days", "planned_delivery_days")
ROUTE_KEYS = ("manufacturing_site", "distribution_center")
COST_IMPUTE_COLUMNS = ("api_cost_per_kg", "excipient_cost_per_kg", "packaging_cost_per_unit",
                       "manufacturing_cost_per_batch")
PRODUCT_KEYS = ("product_category", "formulation")
STOCK_COLUMNS = ("current_stock_days", "safety_stock_days", "reorder_point_days")
CATEGORY_KEYS = ("product_category",)

IMPUTE_SPECS = {
    "route": (ROUTE_KEYS, LEAD_COLUMNS),
    "product": (PRODUCT_KEYS, COST_IMPUTE_COLUMNS),
    "category": (CATEGORY_KEYS, STOCK_COLUMNS),
}


# ---------------------------------------------------------------- drop / repair

def leakage_columns(task: str) -> list[str]:
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}; expected one of {TASKS}")
    cols = list(ALWAYS_DROP)
    if task != "all":
        cols += TASK_DROPS[task]
    return cols


def drop_leakage(df: DataFrame, task: str, keep_key: bool = True) -> DataFrame:
    """pj01: drop identifier/leakage columns for ``task``.  The key is kept
    (rows carry no position in Spark, so it is how labels are re-attached)."""
    drop = [c for c in leakage_columns(task) if not (keep_key and c == KEY)]
    return df.drop(*drop)


def null_negatives(df: DataFrame, col: str = "actual_delivery_days") -> DataFrame:
    """cl01: impossible negative values become NULL."""
    if col not in df.columns:
        return df
    return df.withColumn(col, F.when(F.col(col) < 0, F.lit(None)).otherwise(F.col(col)))


def count_repairs(df: DataFrame, col: str = "actual_delivery_days") -> DataFrame:
    """cl01 report: how many values the repair nulls."""
    return df.agg(F.count_if(F.col(col) < 0).alias("n_fixed"))


# ---------------------------------------------------------------- winsorize

def fit_winsor(train: DataFrame, cols: Sequence[str] = WINSOR_COLUMNS,
               lower: float = WINSOR_LOWER, upper: float = WINSOR_UPPER) -> DataFrame:
    """One row: ``{col}_p01`` and ``{col}_p99`` from train."""
    cols = present(train, cols)
    names = {}
    for c in cols:
        names[(c, lower)] = f"{c}_p01"
        names[(c, upper)] = f"{c}_p99"
    return quantiles_wide(train, cols, [lower, upper], names=names)


def apply_winsor(df: DataFrame, state: DataFrame) -> DataFrame:
    """cl02: clip to the fitted bounds; NULL stays NULL."""
    cols = [c[:-4] for c in state.columns if c.endswith("_p01") and c[:-4] in df.columns]
    j = df.crossJoin(F.broadcast(state))
    out = [clip(F.col(c), F.col(f"{c}_p01"), F.col(f"{c}_p99")).alias(c) if c in cols else F.col(c)
           for c in df.columns]
    return j.select(*out)


# ---------------------------------------------------------------- impute

def _seen_keys(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return train.where(cond).groupBy(*keys).agg(F.lit(True).alias("_seen"))


def fit_group_medians(train: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per-group train medians ``{col}__grp``, one row per key combination seen
    in train (non-NULL keys), including groups whose values are all NULL."""
    keys, cols = list(keys), present(train, cols)
    med = medians(train, cols, by=keys, suffix="__grp")
    return _seen_keys(train, keys).join(med, keys, "left")


def fit_group_and_global(train: DataFrame, keys: Sequence[str], cols: Sequence[str]):
    """(group state, one-row global state) from one ranked sort of train."""
    keys, cols = list(keys), present(train, cols)
    grp, glob = group_and_global_medians(train, cols, keys)
    return _seen_keys(train, keys).join(grp, keys, "left"), glob


def fit_global_medians(train: DataFrame, cols: Sequence[str], suffix: str = "__glob") -> DataFrame:
    """One row of train medians ``{col}{suffix}``."""
    return medians(train, present(train, cols), suffix=suffix)


def apply_group_medians(df: DataFrame, group_state: DataFrame, global_state: DataFrame,
                        keys: Sequence[str], cols: Sequence[str],
                        all_null_group_falls_back: bool = False) -> DataFrame:
    """Fill NULLs: the row's group median when its key was seen in train,
    otherwise the global median.  A seen group whose median is NULL keeps
    NULL (route and product steps) or falls back to the global median
    (category step, ``all_null_group_falls_back``)."""
    keys = list(keys)
    cols = [c for c in present(df, cols) if f"{c}__grp" in group_state.columns]
    # The state should be a written table: the planner then broadcasts it if its bytes allow.
    j = (df.join(group_state, keys, "left")
         .crossJoin(F.broadcast(global_state)))
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        grp, glob = F.col(f"{c}__grp"), F.col(f"{c}__glob")
        if all_null_group_falls_back:
            fill = F.coalesce(grp, glob)
        else:
            fill = F.when(F.col("_seen"), grp).otherwise(glob)
        out.append(F.coalesce(F.col(c), fill).alias(c))
    return j.select(*out)


def impute_by_group(train: DataFrame, df: DataFrame, spec: str) -> DataFrame:
    """cl03 (route), cl04 (product), cl05 (category): fit on train, fill df."""
    keys, cols = IMPUTE_SPECS[spec]
    cols = present(train, cols)
    if not cols:
        return df
    gs, gl = fit_group_and_global(train, keys, cols)
    return apply_group_medians(df, stable(gs), gl, keys, cols, all_null_group_falls_back=(spec == "category"))


def fill_own_group_median(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """wn01: fill NULLs with the median of the row's group in the same frame,
    then the frame's global median (a ``groupby.transform`` fill).  Computed
    with the rank-based quantile and a join, not a window over the group, so
    a hot group is never gathered into one task."""
    return impute_by_group_frame(df, df, keys, cols)


def impute_by_group_frame(fit_on: DataFrame, df: DataFrame, keys, cols) -> DataFrame:
    cols = present(fit_on, cols)
    gs, gl = fit_group_and_global(fit_on, keys, cols)
    return apply_group_medians(df, stable(gs), gl, keys, cols, all_null_group_falls_back=True)


def fit_global_fill(train: DataFrame, exclude: Sequence[str] = (KEY,)) -> tuple[list[str], DataFrame]:
    """cl06 fit: numeric columns with any NULL in train and their medians."""
    cols = numeric_columns(train, exclude=exclude)
    return cols, fit_global_medians(train, cols, suffix="__fill")


def columns_with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Those of ``cols`` that hold a NULL: one row, a flag per column.  Only these are
    sorted for a median."""
    flags = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first().asDict() if cols else {}
    return [c for c in cols if flags[c] == 1]


def apply_global_fill(df: DataFrame, train: DataFrame, state: DataFrame | None = None,
                      exclude: Sequence[str] = (KEY,)) -> DataFrame:
    """cl06: every numeric column that has a NULL in train is filled with the
    train median in df (a NULL only in test stays NULL).  A column without
    NULLs in train keeps its values because its fill is never used."""
    cols = numeric_columns(train, exclude=exclude)
    cols = [c for c in cols if c in df.columns]
    need = columns_with_nulls(train, cols)
    if need and state is None:
        state = fit_global_medians(train, need, suffix="__fill")
    j = df.crossJoin(F.broadcast(state)) if need else df
    # Doubles throughout, so that the schema does not depend on which columns hold a NULL.
    out = [F.coalesce(F.col(c), F.col(f"{c}__fill")).cast("double").alias(c) if c in need
           else F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns]
    return j.select(*out)


def lookup(df: DataFrame, group_state: DataFrame, global_state: DataFrame,
           keys: Sequence[str], col: str) -> DataFrame:
    """jn01: attach ``{col}_lookup``: the fitted group median when the row's
    key was seen in train, else the global median (a dictionary ``get`` with
    a default, as a left equi-join plus a one-row broadcast)."""
    j = df.join(group_state, list(keys), "left").crossJoin(F.broadcast(global_state))
    val = F.when(F.col("_seen"), F.col(f"{col}__grp")).otherwise(F.col(f"{col}__glob"))
    return j.select(*[F.col(c) for c in df.columns], val.alias(f"{col}_lookup"))


def apply_scalars(df: DataFrame, state: DataFrame, exprs: dict) -> DataFrame:
    """jn04: evaluate ``exprs`` against a one-row fitted state (broadcast cross
    join of a single row), keeping df's columns."""
    j = df.crossJoin(F.broadcast(state))
    return j.select(*[F.col(c) for c in df.columns], *[e.alias(n) for n, e in exprs.items()])


def fit_impute_specs(train: DataFrame, specs: dict = IMPUTE_SPECS) -> dict:
    """Fits of cl03-cl05 together: {spec: (group state, one-row global state)}.

    The three steps fill disjoint column sets (lead times, costs, stock days),
    so each step's medians are the same whether computed before or after the
    other steps' fills; one ranked sort computes all of them."""
    specs = {n: (list(k), present(train, c)) for n, (k, c) in specs.items() if present(train, c)}
    long = multi_group_medians(train, specs)
    out = {}
    for name, (keys, cols) in specs.items():
        grp, glob = long[name]
        types = {k: train.schema[k].dataType for k in keys}
        gw = grp.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"{c}__grp")
                                      for c in cols])
        gw = gw.select(*[F.col(k).cast(types[k]).alias(k) for k in keys], *[f"{c}__grp" for c in cols])
        gl = glob.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"{c}__glob") for c in cols])
        out[name] = (_seen_keys(train, keys).join(gw, keys, "left"), gl)
    return out
