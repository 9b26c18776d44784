"""Invariants on the driver tables (sf0.001) and leakage checks."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shipcast.operators import clean as C
from shipcast.operators import encode as E
from shipcast.operators import split as S
from shipcast.operators.oversample import smote
from shipcast.sources.shipments import shipments, train_test


def test_splits_and_folds_partition_rows(spark):
    train, _ = train_test(shipments(spark, SF_SMALL))
    n = train.count()
    h = S.holdout(train.select("order_id", "will_be_delayed"), "will_be_delayed")
    assert h.count() == n
    k = S.kfold(train.select("order_id"))
    sizes = [r["count"] for r in k.groupBy("fold").count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert k.select("order_id").distinct().count() == n


def test_scaled_train_mean_zero_std_one(spark):
    ship = shipments(spark, SF_SMALL)
    train, _ = train_test(ship)
    cols = ["realistic_total_cost", "api_cost_per_kg"]
    out = E.apply_scaler(train, E.fit_scaler(train, cols))
    r = out.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    for c in cols:
        assert abs(r[f"m_{c}"]) < 1e-9 and abs(r[f"s_{c}"] - 1) < 1e-9


def test_smote_balances_classes(spark):
    train, _ = train_test(shipments(spark, SF_SMALL))
    df = E.encode_labels(train).select("label", "realistic_total_cost", "defect_rate_ppm").fillna(0.0)
    out = smote(df, "label", ["realistic_total_cost", "defect_rate_ppm"])
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert len(set(counts.values())) == 1
    assert out.where("is_synthetic = 0").count() == df.count()


def test_test_rows_do_not_change_fitted_state(spark):
    ship = shipments(spark, SF_SMALL)
    train, test = train_test(ship)
    a = C.fit_winsor(train).first().asDict()
    # changing test rows (all costs x 1000) must not move any train statistic
    poisoned = ship.withColumn("api_cost_per_kg", F.when(F.col("split") == "test", F.col("api_cost_per_kg") * 1000)
                               .otherwise(F.col("api_cost_per_kg")))
    b = C.fit_winsor(train_test(poisoned)[0]).first().asDict()
    assert a == b


def test_one_hot_same_columns_both_splits(spark):
    ship = shipments(spark, SF_SMALL)
    train, test = train_test(ship)
    cols = ["product_category", "formulation"]
    sizes = [[f.metadata["ml_attr"]["num_attrs"] for f in E.one_hot(train, df, cols).schema if f.name.endswith("_vec")]
             for df in (train, test)]
    assert sizes[0] == sizes[1] and len(sizes[0]) == 2
