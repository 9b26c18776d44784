"""Scan, sink and profiling queries (io*, pj04-pj08, ag*, so01) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from shipcast.operators import profile as P
from shipcast.plans.catalog import (NUMERIC, SHIP_COLUMNS, STRINGS, _ship, _train, long_sql,
                                    pct2_sql, q, r, register, rounded, union)
from shipcast.plans.oracle import with_shipments
from shipcast.sources import sinks
from shipcast.sources.tables import coerce_timestamps, load_parquet_splits, read_csv, text_schema

W = with_shipments

# ------------------------------------------------------------------ io


@register("io01_scan_parquet", W("SELECT * FROM shipments"))
def io01(spark, sf):
    """Both splits written as Parquet and read by the loader."""
    ship = _ship(spark, sf)
    path = sinks.write_parquet(ship, sinks.new_path(spark, "splits"))
    train, test = load_parquet_splits(spark, f"{path}/split=train", f"{path}/split=test")
    return (train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
            .select(*ship.columns))


@register("io02_scan_csv", W("SELECT * FROM shipments"))
def io02(spark, sf):
    df = _ship(spark, sf)
    path = sinks.write_csv(df, sinks.new_path(spark, "shipments_csv"), partition_by=None)
    return read_csv(spark, path, text_schema(df.schema)).select(*df.columns)


@register("io03_to_timestamp", W("SELECT order_id, order_date, order_timestamp FROM shipments"))
def io03(spark, sf):
    df = _ship(spark, sf).select("order_id", F.col("order_date").cast("string").alias("order_date"),
                                 F.col("order_timestamp").cast("string").alias("order_timestamp"))
    return coerce_timestamps(df)


@register("io05_sink_test_ids", W("SELECT order_id FROM test"))
def io05(spark, sf):
    from shipcast.sources.shipments import train_test
    test = train_test(_ship(spark, sf))[1]
    path = sinks.write_test_ids(test, sinks.new_path(spark, "test_order_ids"))
    return spark.read.schema("order_id long").option("header", True).csv(path)


@register("io07_scan_model_input",
          W(f"SELECT order_id, {', '.join(NUMERIC)} FROM train"))
def io07(spark, sf):
    from shipcast.operators.encode import model_input
    return model_input(_train(spark, sf))


@register("io12_preview", W("SELECT * FROM train ORDER BY order_id LIMIT 20"))
def io12(spark, sf):
    return P.preview(_train(spark, sf))


# ------------------------------------------------------------------ pj

@register("pj04_row_counts", W("SELECT split, count(*) AS n_rows FROM shipments GROUP BY split"))
def pj04(spark, sf):
    return P.row_counts(_ship(spark, sf))


@register("pj06_filter_negative_delivery", W(f"""
SELECT t.*, a.n_negative, a.pct_of_rows FROM
 (SELECT order_id, order_date, planned_delivery_days, actual_delivery_days, shipping_mode
  FROM train WHERE actual_delivery_days < 0 ORDER BY order_id LIMIT 10) t,
 (SELECT n_negative, {pct2_sql('n_negative', 'n')} AS pct_of_rows FROM
   (SELECT count(*) FILTER (WHERE actual_delivery_days < 0) AS n_negative, count(*) AS n FROM train)) a
"""))
def pj06(spark, sf):
    return P.negative_delivery(_train(spark, sf))


@register("pj07_count_negatives", W(f"""
SELECT * FROM ({union([f"SELECT '{c}' AS {q('column')}, count(*) FILTER (WHERE {c} < 0) AS n_negative FROM train"
                       for c in P.NEGATIVE_CHECK_COLUMNS])}) WHERE n_negative > 0
"""))
def pj07(spark, sf):
    return P.count_negatives(_train(spark, sf))


@register("pj08_cross_column_rule", W(
    "SELECT count(*) FILTER (WHERE realistic_total_cost < total_cost_per_batch) AS n_inconsistent FROM train"))
def pj08(spark, sf):
    return P.cross_column_rule(_train(spark, sf))


# ------------------------------------------------------------------ ag

SUMMARY_COLUMNS = list(dict.fromkeys(["realistic_total_cost", "optimal_stock_days", *P.COST_COLUMNS,
                                      *P.RISK_COLUMNS]))


def _summary_sql(cols, std="stddev_samp"):
    parts = [f"SELECT '{c}' AS {q('column')}, avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, "
             f"{std}({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM train"
             for c in cols]
    return W(f"""SELECT {q('column')}, {r('mean', 'mean')}, {r('median', 'median')}, {r('std', 'std')},
 {r('min', 'min')}, {r('max', 'max')} FROM ({union(parts)})""")


@register("ag01_numeric_summary", _summary_sql(SUMMARY_COLUMNS))
def ag01(spark, sf):
    return rounded(P.numeric_summary(_train(spark, sf), SUMMARY_COLUMNS))


def _share_sql(cols, nonnull: bool):
    src = long_sql(cols, "CAST({c} AS VARCHAR)", value="value")
    denom = ("sum(count(*)) OVER (PARTITION BY \"column\")" if nonnull
             else "(SELECT count(*) FROM train)")
    return W(f"""SELECT {q('column')}, value, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / {denom} AS pct
FROM ({src}) WHERE value IS NOT NULL GROUP BY {q('column')}, value""")


@register("ag02_value_share_nonnull", _share_sql(P.SHARE_NONNULL_COLUMNS, True))
def ag02(spark, sf):
    return P.value_share(_train(spark, sf), P.SHARE_NONNULL_COLUMNS, nonnull_denominator=True)


@register("ag03_value_share_allrows", _share_sql(P.SHARE_ALLROWS_COLUMNS, False))
def ag03(spark, sf):
    return P.value_share(_train(spark, sf), P.SHARE_ALLROWS_COLUMNS, nonnull_denominator=False)


@register("ag04_value_counts", W(f"""SELECT {q('column')}, value, count(*) AS n
FROM ({long_sql(P.COUNT_COLUMNS, "CAST({c} AS VARCHAR)", value="value")})
WHERE value IS NOT NULL GROUP BY {q('column')}, value"""))
def ag04(spark, sf):
    return P.value_counts(_train(spark, sf))


@register("ag05_flag_rate", W(union([
    f"SELECT '{c}' AS {q('column')}, count(*) FILTER (WHERE {c} = 1) AS n_flagged, count(*) AS n_rows, "
    f"CAST(count(*) FILTER (WHERE {c} = 1) AS DOUBLE) * 100 / count(*) AS pct FROM train"
    for c in P.FLAG_COLUMNS])))
def ag05(spark, sf):
    return P.flag_rates(_train(spark, sf))


@register("ag06_fixed_bucket_counts", W(union([
    f"SELECT '{c}' AS {q('column')}, '{b}' AS bucket, count(*) FILTER (WHERE {c} = {v}) AS n FROM train"
    for c, b, v in (("will_be_delayed", "0", "0"), ("will_be_delayed", "1", "1"),
                    ("cold_chain_required", "1.0", "1.0"), ("cold_chain_required", "0.0", "0.0"))])))
def ag06(spark, sf):
    return P.fixed_bucket_counts(_train(spark, sf))


@register("ag07_date_range", W("""SELECT min(order_date) AS start_date, max(order_date) AS end_date,
 datediff('day', min(order_date), max(order_date)) AS total_days FROM train"""))
def ag07(spark, sf):
    return P.date_range(_train(spark, sf))


@register("ag08_quarter_counts", W("""SELECT quarter, count(*) AS n FROM train WHERE quarter IS NOT NULL
GROUP BY quarter ORDER BY quarter LIMIT 10"""))
def ag08(spark, sf):
    return P.quarter_counts(_train(spark, sf))


_DAYS = ", ".join(f"('{d}', {i + 1})" for i, d in enumerate(P.WEEKDAYS))


@register("ag09_dow_ordered", W(f"""SELECT d.day_of_week, d.day_idx, coalesce(c.n, 0) AS n
FROM (VALUES {_DAYS}) d(day_of_week, day_idx)
LEFT JOIN (SELECT day_of_week, count(*) AS n FROM train GROUP BY day_of_week) c USING (day_of_week)"""))
def ag09(spark, sf):
    return P.weekday_counts(_train(spark, sf))


_MONTHS = """SELECT strftime(order_date, '%Y-%m') AS year_month, count(*) AS n FROM train
WHERE order_date IS NOT NULL GROUP BY 1"""


@register("ag10_monthly_counts", W(_MONTHS))
def ag10(spark, sf):
    return P.monthly_counts(_train(spark, sf))


@register("ag11_monthly_extremes", W(f"""SELECT {r('(SELECT avg(n) FROM m)', 'avg_per_month')},
 (SELECT year_month FROM m ORDER BY n DESC, year_month LIMIT 1) AS peak_month,
 (SELECT max(n) FROM m) AS peak_n,
 (SELECT year_month FROM m ORDER BY n, year_month LIMIT 1) AS low_month,
 (SELECT min(n) FROM m) AS low_n""", ctes=f"m AS ({_MONTHS})"))
def ag11(spark, sf):
    return rounded(P.monthly_extremes(_train(spark, sf)))


def _group_median_sql():
    from shipcast.operators.clean import IMPUTE_SPECS
    parts = []
    for grouping, (keys, cols) in IMPUTE_SPECS.items():
        cols = [c for c in cols if c in SHIP_COLUMNS]
        k1 = keys[0]
        k2 = keys[1] if len(keys) > 1 else "CAST(NULL AS VARCHAR)"
        notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        gb = ", ".join(keys)
        for c in cols:
            parts.append(f"SELECT '{grouping}' AS grouping, CAST({k1} AS VARCHAR) AS key1, "
                         f"CAST({k2} AS VARCHAR) AS key2, '{c}' AS {q('column')}, "
                         f"quantile_cont({c}, 0.5) AS median FROM train WHERE {notnull} GROUP BY {gb}")
            parts.append(f"SELECT '{grouping}:global', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), '{c}', "
                         f"quantile_cont({c}, 0.5) FROM train")
    return W(f"""SELECT grouping, key1, key2, {q('column')}, {r('median', 'median')}
FROM ({union(parts)}) WHERE median IS NOT NULL""")


@register("ag12_group_median", _group_median_sql())
def ag12(spark, sf):
    return rounded(P.group_medians(_train(spark, sf)))


@register("ag13_route_median_report", W(f"""
SELECT count(m) AS n_routes, {r('g', 'global_median')}, {r('stddev_samp(m)', 'route_std')},
 {r('stddev_samp(m) / g * 100', 'pct_of_global')}
FROM (SELECT quantile_cont(api_lead_time_days, 0.5) AS m FROM train
      WHERE manufacturing_site IS NOT NULL AND distribution_center IS NOT NULL
      GROUP BY manufacturing_site, distribution_center) rm,
     (SELECT quantile_cont(api_lead_time_days, 0.5) AS g FROM train) gm
GROUP BY g"""))
def ag13(spark, sf):
    return rounded(P.route_median_report(_train(spark, sf)))


def _missing_sql(k=None):
    parts = [f"SELECT '{c}' AS {q('column')}, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
             f"count(*) AS n FROM train" for c in SHIP_COLUMNS]
    tail = f" ORDER BY missing_pct DESC, {q('column')} LIMIT {k}" if k else ""
    return W(f"""SELECT {q('column')}, missing_count, {pct2_sql('missing_count', 'n')} AS missing_pct
FROM ({union(parts)}) WHERE missing_count > 0{tail}""")


@register("ag14_missing_summary", _missing_sql())
def ag14(spark, sf):
    return P.missing_summary(_train(spark, sf))


@register("so01_topk_missing", _missing_sql(15))
def so01(spark, sf):
    return P.missing_summary(_train(spark, sf), k=15)


@register("ag15_missing_totals", W(f"""
SELECT split, count(*) FILTER (WHERE k > 0) AS n_columns_with_nulls, CAST(sum(k) AS BIGINT) AS total_null_cells,
 max({pct2_sql('k', 'n')}) AS max_missing_pct
FROM ({union([f"SELECT split, count(*) FILTER (WHERE {c} IS NULL) AS k, count(*) AS n FROM shipments GROUP BY split"
              for c in SHIP_COLUMNS])}) GROUP BY split"""))
def ag15(spark, sf):
    return P.missing_totals(_ship(spark, sf))


def _dup_sql(cols):
    cl = ", ".join(cols)
    return W(f"""SELECT split, CAST(sum(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT split, {cl}, count(*) AS c FROM shipments GROUP BY split, {cl}) GROUP BY split""")


DUP_PROJECTION = ("product_category", "shipping_mode", "market_region", "will_be_delayed")


@register("ag16_duplicate_count", _dup_sql(SHIP_COLUMNS))
def ag16(spark, sf):
    return P.duplicate_count(_ship(spark, sf))


@register("ag16_duplicate_count_projected", _dup_sql(DUP_PROJECTION))
def ag16p(spark, sf):
    return P.duplicate_count(_ship(spark, sf), cols=DUP_PROJECTION)


@register("ag17_cardinality", W(union([
    f"SELECT '{c}' AS {q('column')}, count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) > 20 AS high_cardinality "
    f"FROM train" for c in STRINGS])))
def ag17(spark, sf):
    return P.cardinality(_train(spark, sf))


@register("ag18_iqr_outliers", W(f"""SELECT * FROM ({union([
    f"SELECT '{c}' AS {q('column')}, count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) "
    f"AS n_outliers FROM train, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM train) b" for c in NUMERIC])}) WHERE n_outliers > 0"""))
def ag18(spark, sf):
    return P.iqr_outliers(_train(spark, sf))


@register("ag19_describe", W(f"""SELECT {q('column')}, count, {r('mean', 'mean')}, {r('std', 'std')},
 {r('min', 'min')}, {r('q25', 'q25')}, {r('q50', 'q50')}, {r('q75', 'q75')}, {r('max', 'max')} FROM ({union([
    f"SELECT '{c}' AS {q('column')}, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM train" for c in NUMERIC])})"""))
def ag19(spark, sf):
    return rounded(P.describe(_train(spark, sf)))


def _moments_sql(c):
    u = f"epoch_us(CAST({c} AS TIMESTAMP))"
    at = lambda e: f"make_timestamp(CAST(round({e}) AS BIGINT))"
    return (f"SELECT '{c}' AS \"column\", count({c}) AS count, {at(f'avg({u})')} AS mean, {at(f'min({u})')} AS min, "
            + ", ".join(f"{at(f'quantile_cont({u}, {q})')} AS {n}" for q, n in ((0.25, 'q25'), (0.5, 'q50'), (0.75, 'q75')))
            + f", {at(f'max({u})')} AS max FROM train")


@register("ag19_describe_datetime", W(union([_moments_sql(c) for c in ("order_date", "order_timestamp")])))
def ag19d(spark, sf):
    return P.describe_datetime(_train(spark, sf))


HIST_COLUMNS = ["realistic_total_cost", "optimal_stock_days", "api_cost_per_kg", "excipient_cost_per_kg",
                "packaging_cost_per_unit", "manufacturing_cost_per_batch", *P.RISK_COLUMNS]


@register("ag20_histogram", W(f"""
SELECT g.{q('column')}, g.bin, {r('g.lo + g.bin * ((g.hi - g.lo) / 50)', 'bin_start')}, coalesce(c.n, 0) AS n
FROM (SELECT rg.*, CAST(b.range AS INTEGER) AS bin FROM rg, range(50) b) g
LEFT JOIN (SELECT l.{q('column')}, CAST(least(floor((x - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS n
           FROM l JOIN rg USING ({q('column')}) GROUP BY 1, 2) c
ON g.{q('column')} = c.{q('column')} AND g.bin = c.bin""", ctes=f"""
l AS (SELECT * FROM ({long_sql(HIST_COLUMNS)}) WHERE x IS NOT NULL),
rg AS (SELECT {q('column')}, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
        CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM l GROUP BY 1)"""))
def ag20(spark, sf):
    return rounded(P.histogram(_train(spark, sf), HIST_COLUMNS))


@register("ag21_box_stats", W(f"""
SELECT t.product_category, {r('q1', 'q1')}, {r('median', 'median')}, {r('q3', 'q3')},
 {r('min(x)', 'min')}, {r('max(x)', 'max')},
 {r('min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1))', 'lower_whisker')},
 {r('max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1))', 'upper_whisker')}
FROM (SELECT product_category, api_cost_per_kg AS x FROM train
      WHERE api_cost_per_kg IS NOT NULL AND product_category IS NOT NULL) t
JOIN (SELECT product_category, quantile_cont(api_cost_per_kg, 0.25) AS q1,
             quantile_cont(api_cost_per_kg, 0.5) AS median, quantile_cont(api_cost_per_kg, 0.75) AS q3
      FROM train WHERE api_cost_per_kg IS NOT NULL AND product_category IS NOT NULL GROUP BY 1) b
USING (product_category) GROUP BY t.product_category, q1, median, q3"""))
def ag21(spark, sf):
    return rounded(P.box_stats(_train(spark, sf)))


WINSOR_EFFECT_COLUMNS = [c for c in NUMERIC if "cost" in c or "defect" in c]


@register("ag22_winsor_effect", W(f"""SELECT {q('column')}, {r('p_lo', 'p_lo')}, {r('p_hi', 'p_hi')},
 {r('sb', 'std_before')}, {r('sa', 'std_after')}, {r('(1 - sa / sb) * 100', 'reduction_pct')},
 {r('mb', 'mean_before')}, {r('ma', 'mean_after')} FROM ({union([
    f"SELECT '{c}' AS {q('column')}, p_lo, p_hi, stddev_samp({c}) AS sb, "
    f"stddev_samp(CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, p_hi), p_lo) END) AS sa, "
    f"avg({c}) AS mb, avg(CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, p_hi), p_lo) END) AS ma "
    f"FROM train, (SELECT quantile_cont({c}, 0.01) AS p_lo, quantile_cont({c}, 0.99) AS p_hi FROM train) b "
    f"GROUP BY p_lo, p_hi" for c in WINSOR_EFFECT_COLUMNS])})"""))
def ag22(spark, sf):
    return rounded(P.winsor_effect(_train(spark, sf), WINSOR_EFFECT_COLUMNS))


@register("ag23_skew_log_effect", W(f"""SELECT {r('avg(realistic_total_cost)', 'mean')},
 {r('quantile_cont(realistic_total_cost, 0.5)', 'median')}, {r('skewness(realistic_total_cost)', 'skew')},
 {r('skewness(ln(1 + realistic_total_cost))', 'skew_log1p')} FROM train"""))
def ag23(spark, sf):
    return rounded(P.skew_log_effect(_train(spark, sf)))


@register("ag24_target_stats_pop", _summary_sql(["realistic_total_cost"], std="stddev_pop"))
def ag24(spark, sf):
    return rounded(P.numeric_summary(_train(spark, sf), ["realistic_total_cost"], pop_std=True))


@register("ag26_class_ratio", W(f"""SELECT count(*) FILTER (WHERE will_be_delayed = 0) AS n_neg,
 count(*) FILTER (WHERE will_be_delayed = 1) AS n_pos,
 {r('CAST(count(*) FILTER (WHERE will_be_delayed = 0) AS DOUBLE) / count(*) FILTER (WHERE will_be_delayed = 1)', 'neg_pos_ratio')}
 FROM train"""))
def ag26(spark, sf):
    return rounded(P.class_ratio(_train(spark, sf)))
