"""Profiling operators: counts, shares, summaries, data-quality checks,
outliers, histograms and box statistics.

Every operator is one or two aggregation passes.  Many-column statistics are
computed in *long form*: the columns are stacked into (column, x) rows inside
the scan stage, so a single partial aggregate serves all columns and the
shuffle carries one partial row per (column, partition).  One-row fitted
values (bounds, min/max) are applied with a broadcast cross join, whose size
is fixed at one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.functions.columns import clip, numeric_columns, pct_round2, present, string_columns
from shipcast.operators.quantiles import quantiles_long, quantiles_wide, stable

# Column groups the profile reads (reference names).
TARGETS = ("supply_chain_disruption_risk", "realistic_total_cost", "will_be_delayed",
           "optimal_stock_days")
COST_COLUMNS = ("api_cost_per_kg", "excipient_cost_per_kg", "packaging_cost_per_unit",
                "manufacturing_cost_per_batch", "total_cost_per_batch", "realistic_total_cost")
RISK_COLUMNS = ("supplier_risk_score", "stock_out_risk", "defect_rate_ppm", "quality_risk_score")
SHARE_NONNULL_COLUMNS = ("supply_chain_disruption_risk", "will_be_delayed", "product_category",
                         "formulation")
SHARE_ALLROWS_COLUMNS = ("manufacturing_site", "distribution_center", "market_region",
                         "shipping_mode")
COUNT_COLUMNS = ("temperature_requirement", "day_of_week")
FLAG_COLUMNS = ("gmp_compliant", "fda_approved", "ema_approved", "serialization_required",
                "track_trace_compliant")
NEGATIVE_CHECK_COLUMNS = ("actual_delivery_days", "total_lead_time_days")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
HIGH_CARDINALITY = 20
HIST_BINS = 50
KEY = "order_id"


def stack(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), value: str = "x",
          cast: str | None = "double") -> DataFrame:
    """Unpivot ``cols`` into (by..., column, value) rows inside the scan stage."""
    vals = [(F.col(c).cast(cast) if cast else F.col(c)) for c in cols]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), v.alias(value)) for c, v in zip(cols, vals)])
    return df.select(*by, F.inline(pairs))


# ---------------------------------------------------------------- counts

def row_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """pj04: rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def negative_delivery(train: DataFrame, k: int = 10) -> DataFrame:
    """pj06: first ``k`` rows (by key) with negative delivery days, with the
    total count and its percent of all rows on every row."""
    cols = present(train, (KEY, "order_date", "planned_delivery_days", "actual_delivery_days",
                           "shipping_mode"))
    neg = F.col("actual_delivery_days") < 0
    tot = train.agg(F.count_if(neg).alias("n_negative"), F.count(F.lit(1)).alias("_n"))
    tot = tot.select("n_negative", pct_round2(F.col("n_negative"), F.col("_n")).alias("pct_of_rows"))
    top = train.where(neg).select(*cols).orderBy(KEY).limit(k)
    return top.crossJoin(F.broadcast(tot))


def count_negatives(train: DataFrame, cols: Sequence[str] = NEGATIVE_CHECK_COLUMNS) -> DataFrame:
    """pj07: (column, n_negative) for checked columns with at least one."""
    cols = present(train, cols)
    row = train.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in cols])
    return stack(row, cols, value="n_negative", cast="long").where(F.col("n_negative") > 0)


def cross_column_rule(train: DataFrame, low: str = "realistic_total_cost",
                      high: str = "total_cost_per_batch") -> DataFrame:
    """pj08: rows where ``low < high`` (realistic cost below batch cost)."""
    return train.agg(F.count_if(F.col(low) < F.col(high)).alias("n_inconsistent"))


def value_share(train: DataFrame, cols: Sequence[str], nonnull_denominator: bool) -> DataFrame:
    """ag02 / ag03: (column, value, n, pct).  Null values are not listed; the
    percent is over non-null rows (ag02) or over all rows (ag03)."""
    cols = present(train, cols)
    long = stack(train, cols, value="value", cast="string")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # Denominators: one row per column (a proven broadcast size), aggregated
    # separately so a column with very many values is never one task.
    if nonnull_denominator:
        denom = long.groupBy("column").agg(F.count("value").alias("_d"))
    else:
        denom = long.groupBy("column").agg(F.count(F.lit(1)).alias("_d"))
    return (counts.where(F.col("value").isNotNull()).join(F.broadcast(denom), "column")
            .select("column", "value", "n",
                    (F.col("n").cast("double") * 100 / F.col("_d")).alias("pct")))


def value_counts(train: DataFrame, cols: Sequence[str] = COUNT_COLUMNS) -> DataFrame:
    """ag04: (column, value, n), non-null values only."""
    long = stack(train, present(train, cols), value="value", cast="string")
    return (long.where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def flag_rates(train: DataFrame, cols: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """ag05: percent of all rows whose flag equals 1."""
    cols = present(train, cols)
    row = train.agg(F.count(F.lit(1)).alias("_n"),
                    *[F.count_if(F.col(c) == 1).alias(c) for c in cols])
    long = stack(row, cols, by=["_n"], value="n_flagged", cast="long")
    return long.select("column", "n_flagged", F.col("_n").alias("n_rows"),
                       F.try_divide(F.col("n_flagged").cast("double") * 100, F.col("_n")).alias("pct"))


def fixed_bucket_counts(train: DataFrame, buckets: dict | None = None) -> DataFrame:
    """ag06: counts of named values, 0 when a value is absent."""
    buckets = buckets or {"will_be_delayed": (0, 1), "cold_chain_required": (1.0, 0.0)}
    exprs, keys = [], []
    for c, vals in buckets.items():
        if c not in train.columns:
            continue
        for v in vals:
            name = f"{c}={v}"
            exprs.append(F.count_if(F.col(c) == F.lit(v)).alias(name))
            keys.append((c, str(v), name))
    row = train.agg(*exprs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(v).alias("bucket"),
                               F.col(f"`{n}`").alias("n")) for c, v, n in keys])
    return row.select(F.inline(pairs))


# ---------------------------------------------------------------- dates

def date_range(train: DataFrame, col: str = "order_date") -> DataFrame:
    """ag07: first and last date and the whole days between them."""
    r = train.agg(F.min(col).alias("start_date"), F.max(col).alias("end_date"))
    return r.select("start_date", "end_date",
                    F.expr("timestampdiff(DAY, start_date, end_date)").alias("total_days"))


def quarter_counts(train: DataFrame, k: int = 10) -> DataFrame:
    """ag08: orders per quarter label, sorted by label, first ``k``."""
    return (train.where(F.col("quarter").isNotNull()).groupBy("quarter")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("quarter").limit(k))


def weekday_counts(train: DataFrame, col: str = "day_of_week") -> DataFrame:
    """ag09: counts in Monday..Sunday order, 0 for an absent day."""
    spark = train.sparkSession
    days = spark.range(1).select(F.posexplode(F.array(*[F.lit(d) for d in WEEKDAYS]))
                                 .alias("day_idx", col))
    counts = train.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return (F.broadcast(days).join(counts, col, "left")
            .select(col, (F.col("day_idx") + 1).alias("day_idx"),
                    F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n")))


def _month(col: str):
    return F.date_format(F.col(col), "yyyy-MM")


def monthly_counts(train: DataFrame, col: str = "order_date") -> DataFrame:
    """ag10: orders per calendar month."""
    return (train.where(F.col(col).isNotNull()).groupBy(_month(col).alias("year_month"))
            .agg(F.count(F.lit(1)).alias("n")))


def monthly_extremes(train: DataFrame, col: str = "order_date") -> DataFrame:
    """ag11: mean orders per month, peak and lowest month (earliest on ties)."""
    m = monthly_counts(train, col)
    return m.agg(
        F.avg("n").alias("avg_per_month"),
        F.max(F.struct(F.col("n"), F.expr("-unix_date(to_date(year_month || '-01'))").alias("o"),
                       F.col("year_month"))).alias("_pk"),
        F.min(F.struct(F.col("n"), F.col("year_month"))).alias("_lo"),
    ).select("avg_per_month",
             F.col("_pk.year_month").alias("peak_month"), F.col("_pk.n").alias("peak_n"),
             F.col("_lo.year_month").alias("low_month"), F.col("_lo.n").alias("low_n"))


# ---------------------------------------------------------------- statistics

def numeric_summary(train: DataFrame, cols: Sequence[str], pop_std: bool = False) -> DataFrame:
    """ag01 / ag24: (column, mean, median, std, min, max); sample std by
    default, population std for ``pop_std``."""
    cols = list(dict.fromkeys(present(train, cols)))
    long = stack(train, cols)
    std = F.stddev_pop("x") if pop_std else F.stddev_samp("x")
    basic = long.groupBy("column").agg(F.avg("x").alias("mean"), std.alias("std"),
                                       F.min("x").alias("min"), F.max("x").alias("max"))
    med = quantiles_long(train, cols, [0.5]).select("column", F.col("value").alias("median"))
    return basic.join(med, "column", "left").select("column", "mean", "median", "std", "min", "max")


def group_medians(train: DataFrame, specs: dict | None = None) -> DataFrame:
    """ag12: long form (grouping, key1, key2, column, median) of the imputation
    medians: per route, per product, per category, and global.  All
    groupings come from one ranked sort (``multi_group_medians``)."""
    from shipcast.operators.clean import IMPUTE_SPECS
    from shipcast.operators.quantiles import multi_group_medians
    specs = specs or IMPUTE_SPECS
    specs = {n: (list(k), present(train, c)) for n, (k, c) in specs.items() if present(train, c)}
    res = multi_group_medians(train, specs)
    out = None
    for grouping, (keys, _cols) in specs.items():
        q, g = res[grouping]
        k2 = F.col(keys[1]).cast("string") if len(keys) > 1 else F.lit(None).cast("string")
        part = q.select(F.lit(grouping).alias("grouping"), F.col(keys[0]).cast("string").alias("key1"),
                        k2.alias("key2"), "column", F.col("value").alias("median"))
        part = part.unionByName(g.select(F.lit(f"{grouping}:global").alias("grouping"),
                                         F.lit(None).cast("string").alias("key1"),
                                         F.lit(None).cast("string").alias("key2"),
                                         "column", F.col("value").alias("median")))
        out = part if out is None else out.unionByName(part)
    return out


def route_median_report(train: DataFrame, col: str = "api_lead_time_days",
                        keys: Sequence[str] = ("manufacturing_site", "distribution_center")) -> DataFrame:
    """ag13: global median, sample std of the route medians and that std as a
    percent of the global median."""
    route = quantiles_long(train, [col], [0.5], by=keys).select(F.col("value").alias("m"))
    spread = route.agg(F.count("m").alias("n_routes"), F.stddev_samp("m").alias("route_std"))
    glob = quantiles_wide(train, [col], [0.5], names={(col, 0.5): "global_median"})
    return (spread.crossJoin(glob)
            .select("n_routes", "global_median", "route_std",
                    (F.try_divide(F.col("route_std"), F.col("global_median")) * 100).alias("pct_of_global")))


def missing_summary(df: DataFrame, k: int | None = None) -> DataFrame:
    """ag14 / so01: (column, missing_count, missing_pct) for columns with
    nulls, largest percent first; ``k`` keeps the top k."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = stack(row, cols, by=["_n"], value="missing_count", cast="long")
    out = (long.where(F.col("missing_count") > 0)
           .select("column", "missing_count",
                   pct_round2(F.col("missing_count"), F.col("_n")).alias("missing_pct")))
    if k is not None:
        out = out.orderBy(F.col("missing_pct").desc(), F.col("column")).limit(k)
    return out


def missing_totals(df: DataFrame, split_col: str = "split") -> DataFrame:
    """ag15: per split: columns with nulls, total null cells, highest percent."""
    cols = [c for c in df.columns if c != split_col]
    per = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = stack(per, cols, by=[split_col, "_n"], value="k", cast="long")
    return long.groupBy(split_col).agg(
        F.count_if(F.col("k") > 0).alias("n_columns_with_nulls"),
        F.sum("k").alias("total_null_cells"),
        F.max(pct_round2(F.col("k"), F.col("_n"))).alias("max_missing_pct"))


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None,
                    split_col: str = "split") -> DataFrame:
    """ag16: per split, rows equal to an earlier row over ``cols`` (default
    all).  NULL equals NULL, as in pandas ``duplicated``."""
    cols = list(cols) if cols else [c for c in df.columns if c != split_col]
    # 128 bits a row are counted first; only rows whose hash repeats are grouped by their values.
    marked = df.select(split_col, *cols, F.xxhash64(*cols).alias("_h1"), F.xxhash64(F.lit(1), *cols).alias("_h2"))
    again = stable(marked.groupBy(split_col, "_h1", "_h2").agg(F.count(F.lit(1)).alias("_c"))
                   .where("_c > 1").select(F.col(split_col).alias("_s"), "_h1", "_h2"))
    some = marked.join(again, (marked[split_col].eqNullSafe(again["_s"])) & (marked["_h1"] == again["_h1"])
                       & (marked["_h2"] == again["_h2"]), "left_semi")
    g = some.groupBy(split_col, *cols).agg(F.count(F.lit(1)).alias("_c"))
    found = g.groupBy(split_col).agg(F.sum(F.col("_c") - 1).alias("_d"))
    # A split without duplicates still has its row.
    splits = df.select(F.col(split_col).alias("_s")).distinct()
    return (splits.join(found, splits["_s"].eqNullSafe(found[split_col]), "left")
            .select(F.col("_s").alias(split_col), F.coalesce("_d", F.lit(0)).cast("long").alias("n_duplicates")))


def cardinality(train: DataFrame, cols: Sequence[str] | None = None,
                limit: int = HIGH_CARDINALITY) -> DataFrame:
    """ag17: distinct non-null values per string column, flagged above ``limit``."""
    cols = list(cols) if cols else string_columns(train)
    long = stack(train, cols, value="value", cast="string").where(F.col("value").isNotNull())
    d = long.groupBy("column").agg(F.count_distinct("value").alias("n_distinct"))
    return d.select("column", "n_distinct", (F.col("n_distinct") > limit).alias("high_cardinality"))


def iqr_outliers(train: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """ag18: per numeric column, values outside [Q1-1.5 IQR, Q3+1.5 IQR];
    only columns with at least one."""
    cols = list(cols) if cols else numeric_columns(train, exclude=[KEY])
    q = quantiles_long(train, cols, [0.25, 0.75])
    b = q.groupBy("column").agg(F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
                                F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    b = b.select("column", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo"),
                 (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi"))
    # |cols| rows: a broadcast of proven size.
    long = stack(train, cols).join(F.broadcast(b), "column")
    out = long.groupBy("column").agg(
        F.count_if((F.col("x") < F.col("lo")) | (F.col("x") > F.col("hi"))).alias("n_outliers"))
    return out.where(F.col("n_outliers") > 0)


def describe(train: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """ag19: count, mean, sample std, min, quartiles, max per numeric column
    (exact quartiles; ``DataFrame.summary`` would approximate them)."""
    cols = list(cols) if cols else numeric_columns(train, exclude=[KEY])
    long = stack(train, cols)
    basic = long.groupBy("column").agg(F.count("x").alias("count"), F.avg("x").alias("mean"),
                                       F.stddev_samp("x").alias("std"), F.min("x").alias("min"),
                                       F.max("x").alias("max"))
    q = quantiles_long(train, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                                   for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return basic.join(qw, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_datetime(train: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """ag19, datetime part: count, mean, min, quartiles, max (no std) per
    datetime column, as timestamps."""
    from shipcast.functions.columns import datetime_columns
    cols = list(cols) if cols else datetime_columns(train)
    micros = train.select(*[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in cols])
    long = stack(micros, cols)
    basic = long.groupBy("column").agg(F.count("x").alias("count"), F.avg("x").alias("_mean"),
                                       F.min("x").alias("_min"), F.max("x").alias("_max"))
    q = quantiles_long(micros, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                                   for p, n in ((0.25, "_q25"), (0.5, "_q50"), (0.75, "_q75"))])
    ts = lambda c: F.timestamp_micros(F.round(F.col(c)).cast("long")).cast("timestamp_ntz")
    return basic.join(qw, "column", "left").select(
        "column", "count", ts("_mean").alias("mean"), ts("_min").alias("min"),
        ts("_q25").alias("q25"), ts("_q50").alias("q50"), ts("_q75").alias("q75"),
        ts("_max").alias("max"))


def histogram(train: DataFrame, cols: Sequence[str], bins: int = HIST_BINS) -> DataFrame:
    """ag20: equal-width histogram per column, last bin closed, nulls dropped,
    empty bins listed with 0 (NumPy ``histogram`` bin rule)."""
    cols = present(train, cols)
    long = stack(train, cols).where(F.col("x").isNotNull())
    rng = long.groupBy("column").agg(F.min("x").alias("_mn"), F.max("x").alias("_mx"))
    rng = rng.select("column",
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi"))
    binned = long.join(F.broadcast(rng), "column").select(
        "column", F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                          F.lit(bins - 1)).cast("int").alias("bin"))
    counts = binned.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("_n"))
    spark = train.sparkSession
    grid = rng.crossJoin(F.broadcast(spark.range(bins).select(F.col("id").cast("int").alias("bin"))))
    width = (F.col("hi") - F.col("lo")) / bins
    return (grid.join(counts, ["column", "bin"], "left")
            .select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                    F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n")))


def box_stats(train: DataFrame, col: str = "api_cost_per_kg", by: str = "product_category") -> DataFrame:
    """ag21: per group min, quartiles, max and the whiskers (last value inside
    1.5 IQR of the box)."""
    q = quantiles_wide(train, [col], [0.25, 0.5, 0.75], by=[by],
                       names={(col, 0.25): "q1", (col, 0.5): "median", (col, 0.75): "q3"})
    q = q.select(by, "q1", "median", "q3",
                 (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_lf"),
                 (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_uf"))
    x = F.col(col)
    j = train.where(x.isNotNull() & F.col(by).isNotNull()).select(by, x.alias("x")).join(q, by)
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min("x").alias("min"), F.max("x").alias("max"),
        F.min(F.when(F.col("x") >= F.col("_lf"), F.col("x"))).alias("lower_whisker"),
        F.max(F.when(F.col("x") <= F.col("_uf"), F.col("x"))).alias("upper_whisker"))


def winsor_effect(train: DataFrame, cols: Sequence[str], lower: float = 0.01,
                  upper: float = 0.99) -> DataFrame:
    """ag22: sample std before and after clipping at the p1/p99 of the column,
    and the percent reduction; mean before and after."""
    cols = present(train, cols)
    b = quantiles_long(train, cols, [lower, upper]).groupBy("column").agg(
        F.max(F.when(F.col("p") == lower, F.col("value"))).alias("p_lo"),
        F.max(F.when(F.col("p") == upper, F.col("value"))).alias("p_hi"))
    long = stack(train, cols).join(F.broadcast(b), "column")
    c = clip(F.col("x"), F.col("p_lo"), F.col("p_hi"))
    s = long.groupBy("column", "p_lo", "p_hi").agg(
        F.stddev_samp("x").alias("std_before"), F.stddev_samp(c).alias("std_after"),
        F.avg("x").alias("mean_before"), F.avg(c).alias("mean_after"))
    return s.select("column", "p_lo", "p_hi", "std_before", "std_after",
                    ((1 - F.try_divide(F.col("std_after"), F.col("std_before"))) * 100).alias("reduction_pct"),
                    "mean_before", "mean_after")


def _g1_skew(c):
    """Bias-corrected sample skewness (pandas ``skew``)."""
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def skew_log_effect(train: DataFrame, col: str = "realistic_total_cost") -> DataFrame:
    """ag23: mean, median and skew of a cost, and the skew of log1p(cost)."""
    x = F.col(col)
    s = train.agg(F.avg(x).alias("mean"), _g1_skew(x).alias("skew"),
                  _g1_skew(F.log1p(x)).alias("skew_log1p"))
    med = quantiles_wide(train, [col], [0.5], names={(col, 0.5): "median"})
    return s.crossJoin(med).select("mean", "median", "skew", "skew_log1p")


def class_ratio(train: DataFrame, label: str = "will_be_delayed") -> DataFrame:
    """ag26: negatives / positives of a 0/1 label (the positive-class weight)."""
    return train.agg(F.count_if(F.col(label) == 0).alias("n_neg"),
                     F.count_if(F.col(label) == 1).alias("n_pos")).select(
        "n_neg", "n_pos", F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos")).alias("neg_pos_ratio"))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """io12: the first ``n`` rows in key order."""
    return df.orderBy(KEY).limit(n)
