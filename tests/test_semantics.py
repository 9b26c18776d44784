"""Micro-fixtures: the null and number rules, with hand-computed answers."""

import math

import pytest
from pyspark.sql import functions as F

from shipcast.operators import clean as C
from shipcast.operators import correlate as K
from shipcast.operators import encode as E
from shipcast.operators import profile as P
from shipcast.operators import quantiles
from shipcast.operators.quantiles import medians, quantiles_wide


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_group_median_null_key_and_all_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 9.0), ("b", None)], "g string, x double")
    m = medians(df, ["x"], by=["g"])
    assert rows(m.orderBy("g"), "g", "x") == [("a", 1.0)]  # b has no values, null key dropped
    g = medians(df, ["x"]).first()["x"]
    assert g == 5.0


def test_impute_route_rules(spark):
    train = spark.createDataFrame(
        [(1, "a", "x", 1.0), (2, "a", "x", None), (3, None, "x", 9.0), (4, "b", "y", None)],
        "order_id long, manufacturing_site string, distribution_center string, api_lead_time_days double")
    test = spark.createDataFrame([(5, "c", "z", None), (6, None, "x", None)], train.schema)
    both = train.unionByName(test)
    out = {r.order_id: r.api_lead_time_days for r in C.impute_by_group(train, both, "route").collect()}
    assert out[2] == 1.0          # group median
    assert out[4] is None         # seen group, all values null: left for the global step
    assert out[5] == 5.0          # unseen key -> global
    assert out[6] == 5.0          # null key -> global
    assert out[3] == 9.0          # present value kept


def test_category_fill_keeps_values_with_null_key(spark):
    train = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, None, 9.0), (4, "b", None)],
                                  "order_id long, product_category string, current_stock_days double")
    out = {r.order_id: r.current_stock_days for r in C.impute_by_group(train, train, "category").collect()}
    assert out == {1: 1.0, 2: 1.0, 3: 9.0, 4: 5.0}


def test_value_share_denominators(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    nn = {r.value: round(r.pct, 2) for r in P.value_share(df, ["c"], True).collect()}
    al = {r.value: round(r.pct, 2) for r in P.value_share(df, ["c"], False).collect()}
    assert nn == {"a": 66.67, "b": 33.33}
    assert al == {"a": 50.0, "b": 25.0}


def test_one_hot_drop_first_and_unseen(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    test = spark.createDataFrame([("b",), ("c",), ("d",), (None,)], "g string")
    out = E.one_hot_long(train, test, ["g"], ["g"])
    assert sorted(rows(out, "g", "feature")) == [("b", "g_b"), ("c", "g_c")]


def test_one_hot_keeps_every_value_of_a_wide_column(spark):
    """A thousand values: every value but the first has its slot, as vector and as rows."""
    from pyspark.ml.functions import vector_to_array
    df = spark.range(1000).selectExpr("id", "format_string('s%04d', id) AS g")
    vec = E.one_hot(df, df, ["g"]).select("id", vector_to_array("g_vec").alias("v")).collect()
    assert all(len(r.v) == 999 and sum(r.v) == (r.id > 0) for r in vec)
    assert len({tuple(r.v) for r in vec}) == 1000
    assert E.one_hot_long(df, df, ["g"], ["id"]).count() == 999


def test_quartile_bucket_right_closed(spark):
    from shipcast.operators.features import engineer
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "supplier_historical_performance double")
    out = engineer(df, df)
    # q25 = 1.5, q50 = 2, q75 = 2.5 -> 1 <= q25: 0; 2 <= q50: 1; 3 > q75: 3
    assert [r.supplier_perf_bucket for r in out.collect()] == [0, 1, 3]


def test_idxmax_tie_takes_earliest_month(spark):
    df = spark.createDataFrame([(f"2020-0{m}-01",) for m, k in ((1, 3), (2, 3), (3, 1), (4, 1)) for _ in range(k)],
                               "d string").select(F.to_timestamp_ntz("d").alias("order_date"))
    r = P.monthly_extremes(df).first()
    assert (r.peak_month, r.peak_n, r.low_month, r.low_n) == ("2020-01", 3, "2020-03", 1)


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    p = K.corr_pairs(df, ["a", "b"]).first()
    assert p.correlation is None


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (5.0,), (10.0,)], "x double")
    h = P.histogram(df, ["x"], bins=5).orderBy("bin")
    assert [r.n for r in h.collect()] == [2, 1, 1, 0, 1]


def test_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (2.0, 3.0), (float("nan"), 1.0), (float("nan"), 1.0)],
                               "a double, b double").withColumn("split", F.lit("train"))
    assert P.duplicate_count(df).first().n_duplicates == 2


def test_clip_keeps_null(spark):
    from shipcast.functions.columns import clip
    df = spark.createDataFrame([(None,), (0.0,), (9.0,)], "x double")
    out = df.select(clip(F.col("x"), F.lit(1.0), F.lit(5.0)).alias("y"))
    assert [r.y for r in out.collect()] == [None, 1.0, 5.0]


def test_population_scaling(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    st = E.fit_scaler(df, ["x"]).first()
    assert math.isclose(st["x__std"], 1.247219, rel_tol=1e-6)
    out = E.apply_scaler(df, E.fit_scaler(df, ["x"]))
    vals = [r.x for r in out.collect()]
    assert math.isclose(sum(vals), 0.0, abs_tol=1e-12)


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r.x for r in E.apply_scaler(df, E.fit_scaler(df, ["x"])).collect()] == [0.0, 0.0]


def test_winsor_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "api_cost_per_kg double")
    st = C.fit_winsor(df, ["api_cost_per_kg"])
    out = C.apply_winsor(df, st)
    vals = [r.api_cost_per_kg for r in out.collect()]
    assert min(v for v in vals if v is not None) == 1.0 and max(v for v in vals if v is not None) == 99.0
    assert vals.count(None) == 1


def test_quantiles_match_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(1)
    data = [(int(g), float(x)) for g, x in zip(rng.integers(0, 3, 500), rng.normal(size=500))]
    df = spark.createDataFrame(data, "g long, x double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    pdf = pd.DataFrame(data, columns=["g", "x"])
    for strategy in ("rank", "agg"):
        got = quantiles_wide(df, ["x"], probs, by=["g"]).collect()
        for r in got:
            exp = pdf[pdf.g == r.g].x.quantile(probs).values
            for p, e in zip(probs, exp):
                assert math.isclose(r[f"x__q{round(p * 10000):05d}"], e, rel_tol=1e-9, abs_tol=1e-12)


def test_hot_value_quantile(spark):
    """A value repeated for most rows is spread over partitions and still exact."""
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.col("id").cast("double"))
                                   .otherwise(F.lit(7.0)).alias("x"))
    got = quantiles_wide(df, ["x"], [0.5, 0.9]).first()
    import numpy as np
    xs = np.array([float(i) if i % 3 == 0 else 7.0 for i in range(20000)])
    assert math.isclose(got["x__q05000"], float(np.quantile(xs, 0.5)))
    assert math.isclose(got["x__q09000"], float(np.quantile(xs, 0.9)))


@pytest.mark.parametrize("reach", [quantiles.REACH, -0.2])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, reach):
    """Groups far beyond a sketch, infinite values, NULL keys; a negative reach makes brackets miss."""
    import numpy as np
    monkeypatch.setattr(quantiles, "REACH", reach)
    monkeypatch.setattr(quantiles, "SKETCH", 100)
    rng = np.random.default_rng(4)
    xs = np.concatenate([rng.normal(size=20000), np.repeat(0.25, 9000), [math.inf, -math.inf] * 3])
    rows = [(None if k % 10 == 0 else int(k % 3 == 0), float(x)) for k, x in enumerate(rng.permutation(xs))]
    rows += [(2, 5.0), (2, None), (2, math.nan), (3, None)]
    df = spark.createDataFrame(rows, "g long, x double")
    probs = [0.0, 0.01, 0.5, 0.99, 1.0]
    grp, glob = quantiles.group_and_global_quantiles(df, ["x"], probs, ["g"])
    def plain(p, keep):
        """Linear interpolation, but an infinite value itself where both ends are equal."""
        own = sorted(x for g, x in rows if keep(g) and x is not None and not math.isnan(x))
        at = p * (len(own) - 1)
        lo, hi = own[math.floor(at)], own[math.ceil(at)]
        return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))

    want = {(g, p): plain(p, lambda k: k == g) for g in (0, 1, 2) for p in probs}
    assert {(r.g, r.p): r.value for r in grp.collect()} == pytest.approx(want)
    assert [r.value for r in glob.orderBy("p").collect()] == pytest.approx([plain(p, lambda k: True) for p in probs])


def test_one_hot_vector_path_drops_first(spark):
    """One sparse vector: the first category is dropped, unseen and NULL give zeros."""
    from pyspark.ml.functions import vector_to_array
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    test = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None)], "k int, g string")
    out = E.one_hot(train, test, ["g"]).select("k", vector_to_array("g_vec").alias("v")).orderBy("k")
    vecs = [r.v for r in out.collect()]
    assert all(len(v) == 2 for v in vecs)
    assert vecs[0] == [0.0, 0.0]                       # first category dropped
    assert sorted(map(tuple, vecs[1:3])) == [(0.0, 1.0), (1.0, 0.0)]  # b and c one slot each
    assert vecs[3] == [0.0, 0.0] and vecs[4] == [0.0, 0.0]  # unseen and NULL


def test_one_hot_stages_cost_a_row_its_values_not_the_slots(spark):
    """No stage walks a vector's slots for each row; a column of one value has one empty slot."""
    train = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "g string, h string")
    _, stages = E.fit_one_hot(train, ["g", "h"])
    assert {type(s).__name__ for s in stages} == {"StringIndexerModel", "OneHotEncoderModel"}
    assert [tuple(r) for r in E.feature_names(stages, spark).collect()] == [("g_vec", 1, "c"), ("g_vec", 2, "b")]
    test = spark.createDataFrame([("b", "x"), ("d", "y"), (None, None)], "g string, h string")
    got = [(r.g_vec.toArray().tolist(), r.h_vec.toArray().tolist()) for r in E.one_hot(train, test, ["g", "h"]).collect()]
    assert sorted(got) == [([0.0, 0.0], [0.0]), ([0.0, 0.0], [0.0]), ([0.0, 1.0], [0.0])]


def test_vector_cells_leave_a_sparse_vector_sparse(spark):
    """A vector of two billion slots could not be made dense."""
    from pyspark.ml.linalg import Vectors
    from shipcast.functions.columns import vector_cells, vector_size
    df = spark.createDataFrame([(1, Vectors.sparse(2_000_000_000, [4, 1_999_999_999], [1.0, -0.5])),
                                (2, Vectors.dense([0.0, 2.5, 0.0])), (3, Vectors.sparse(3, [], []))], ["k", "v"])
    got = [(r.n, [tuple(c) for c in r.c]) for r in df.orderBy("k").select(
        vector_size("v").alias("n"), vector_cells("v").alias("c")).collect()]
    assert got == [(2_000_000_000, [(5, 1.0), (2_000_000_000, -0.5)]), (3, [(2, 2.5)]), (3, [])]


def test_vector_text_of_a_very_long_sparse_vector(spark):
    """io06 writes the stored entries: two billion slots could not be made dense."""
    from pyspark.ml.linalg import Vectors
    from shipcast.sources.sinks import vector_text
    df = spark.createDataFrame([(1, Vectors.sparse(2_000_000_000, [4, 1_999_999_999], [1.0, -0.5])), (2, Vectors.sparse(3, [], []))], ["k", "v"])
    assert [r.t for r in df.orderBy("k").select(vector_text("v").alias("t")).collect()] == ["5:1.0 2000000000:-0.5", ""]
