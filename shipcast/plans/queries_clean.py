"""Cleaning and lookup-join queries (pj01, cl*, jn01, jn04, wn01) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from shipcast.operators import clean as C
from shipcast.plans.catalog import NUMERIC, SHIP_COLUMNS, _ship, _train, r, register, rounded
from shipcast.plans.oracle import with_shipments
from shipcast.sources.shipments import train_test

W = with_shipments


def _split_frames(spark, sf):
    ship = _ship(spark, sf)
    train, _ = train_test(ship)
    return ship, train


@register("pj01_drop_leakage", W("SELECT * EXCLUDE (will_be_delayed, actual_delivery_days) FROM shipments"))
def pj01(spark, sf):
    return C.drop_leakage(_ship(spark, sf), "delay")


@register("cl01_null_negatives", W("""SELECT order_id, split,
 CASE WHEN actual_delivery_days < 0 THEN NULL ELSE actual_delivery_days END AS actual_delivery_days FROM shipments"""))
def cl01(spark, sf):
    return C.null_negatives(_ship(spark, sf)).select("order_id", "split", "actual_delivery_days")


def _winsor_sql():
    cols = [c for c in C.WINSOR_COLUMNS if c in SHIP_COLUMNS]
    fit = ", ".join(f"quantile_cont({c}, 0.01) AS {c}_p01, quantile_cont({c}, 0.99) AS {c}_p99" for c in cols)
    sel = ", ".join(r(f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest(least({c}, {c}_p99), {c}_p01) END", c)
                    for c in cols)
    return W(f"SELECT order_id, split, {sel} FROM shipments, (SELECT {fit} FROM train) b"), cols


_WSQL, _WCOLS = _winsor_sql()


@register("cl02_winsorize", _WSQL)
def cl02(spark, sf):
    ship, train = _split_frames(spark, sf)
    out = C.apply_winsor(ship, C.fit_winsor(train))
    return rounded(out.select("order_id", "split", *_WCOLS))


def _impute_sql(spec: str, fallback_all_null: bool, source="shipments", fit="train", with_split=True):
    keys, cols = C.IMPUTE_SPECS[spec]
    cols = [c for c in cols if c in SHIP_COLUMNS]
    notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    kl = ", ".join(keys)
    g = ", ".join(f"quantile_cont({c}, 0.5) AS {c}__g" for c in cols)
    gl = ", ".join(f"quantile_cont({c}, 0.5) AS {c}__gl" for c in cols)
    on = " AND ".join(f"s.{k} = g.{k}" for k in keys)
    sel = []
    for c in cols:
        fill = (f"coalesce(g.{c}__g, gl.{c}__gl)" if fallback_all_null
                else f"CASE WHEN g.{keys[0]} IS NOT NULL THEN g.{c}__g ELSE gl.{c}__gl END")
        sel.append(r(f"coalesce(s.{c}, {fill})", c))
    split = "s.split, " if with_split else ""
    return W(f"""SELECT s.order_id, {split}{', '.join(sel)}
FROM {source} s LEFT JOIN (SELECT {kl}, {g} FROM {fit} WHERE {notnull} GROUP BY {kl}) g ON {on}
CROSS JOIN (SELECT {gl} FROM {fit}) gl"""), cols


def _impute_query(spec):
    def fn(spark, sf):
        ship, train = _split_frames(spark, sf)
        cols = [c for c in C.IMPUTE_SPECS[spec][1] if c in ship.columns]
        return rounded(C.impute_by_group(train, ship, spec).select("order_id", "split", *cols))
    return fn


for _name, _spec, _fb in (("cl03_impute_route", "route", False),
                          ("cl04_impute_product", "product", False),
                          ("cl05_impute_category", "category", True)):
    register(_name, _impute_sql(_spec, _fb)[0])(_impute_query(_spec))


@register("wn01_group_fill", _impute_sql("category", True, source="train", fit="train", with_split=False)[0])
def wn01(spark, sf):
    train = _train(spark, sf)
    out = C.fill_own_group_median(train, C.CATEGORY_KEYS, C.STOCK_COLUMNS)
    return rounded(out.select("order_id", *[c for c in C.STOCK_COLUMNS if c in train.columns]))


def _global_fill_sql():
    st = ", ".join(f"quantile_cont({c}, 0.5) AS {c}__m, count(*) FILTER (WHERE {c} IS NULL) AS {c}__k"
                   for c in NUMERIC)
    sel = ", ".join(r(f"CASE WHEN {c}__k > 0 THEN coalesce({c}, {c}__m) ELSE {c} END", c) for c in NUMERIC)
    return W(f"SELECT order_id, split, {sel} FROM shipments, (SELECT {st} FROM train) f")


@register("cl06_impute_global", _global_fill_sql())
def cl06(spark, sf):
    ship, train = _split_frames(spark, sf)
    return rounded(C.apply_global_fill(ship, train).select("order_id", "split", *NUMERIC))


@register("jn01_lookup_join", W(f"""SELECT s.order_id, s.split,
 {r('CASE WHEN g.manufacturing_site IS NOT NULL THEN g.m ELSE gl.m END', 'api_lead_time_days_lookup')}
FROM shipments s LEFT JOIN (SELECT manufacturing_site, distribution_center, quantile_cont(api_lead_time_days, 0.5) AS m
  FROM train WHERE manufacturing_site IS NOT NULL AND distribution_center IS NOT NULL GROUP BY 1, 2) g
 ON s.manufacturing_site = g.manufacturing_site AND s.distribution_center = g.distribution_center
CROSS JOIN (SELECT quantile_cont(api_lead_time_days, 0.5) AS m FROM train) gl"""))
def jn01(spark, sf):
    ship, train = _split_frames(spark, sf)
    keys = list(C.ROUTE_KEYS)
    gs = C.fit_group_medians(train, keys, ["api_lead_time_days"])
    gl = C.fit_global_medians(train, ["api_lead_time_days"])
    out = C.lookup(ship, gs, gl, keys, "api_lead_time_days")
    return rounded(out.select("order_id", "split", "api_lead_time_days_lookup"))


@register("jn04_scalar_apply", W(f"""SELECT order_id, split, {r('defect_rate_ppm - m', 'defect_rate_centered')}
FROM shipments, (SELECT avg(defect_rate_ppm) AS m FROM train) t"""))
def jn04(spark, sf):
    ship, train = _split_frames(spark, sf)
    state = train.agg(F.avg("defect_rate_ppm").alias("_m"))
    out = C.apply_scalars(ship, state, {"defect_rate_centered": F.col("defect_rate_ppm") - F.col("_m")})
    return rounded(out.select("order_id", "split", "defect_rate_centered"))
