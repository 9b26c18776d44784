"""Model metrics as aggregates over (label, prediction[, score]) tables.

All metrics are exact and distributed: sums and counts with partial
aggregation; AUC is the Mann-Whitney statistic computed from per-score
counts and an exclusive prefix sum of negatives, where the prefix sum uses
the range-partitioned ``rank_rows`` plan rather than a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipcast.operators.quantiles import stable

# Business cost of over- and under-stocking (task D).
OVERSTOCK_COST, UNDERSTOCK_COST = 1.0, 3.0


def f1_weighted(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """ml14: support-weighted F1 (0 for a class with no correct prediction)."""
    conf = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    tp = conf.where(F.col(label) == F.col(pred)).select(F.col(label).alias("c"), F.col("n").alias("tp"))
    sup = conf.groupBy(label).agg(F.sum("n").alias("support")).withColumnRenamed(label, "c")
    prd = conf.groupBy(pred).agg(F.sum("n").alias("predicted")).withColumnRenamed(pred, "c")
    per = sup.join(prd, "c", "full").join(tp, "c", "left").fillna(0, ["support", "predicted", "tp"])
    f1 = F.when(F.col("support") + F.col("predicted") > 0,
                2 * F.col("tp") / (F.col("support") + F.col("predicted"))).otherwise(0.0)
    return per.agg(F.try_divide(F.sum(f1 * F.col("support")), F.sum("support")).alias("f1_weighted"),
                   F.sum("support").alias("n"))


def regression_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """ml15: RMSE, MAE, MAPE% over y != 0, R^2 (1 - SSE/SST)."""
    y, p = F.col(label), F.col(pred)
    e = y - p
    s = df.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("_sse"), F.avg(F.abs(e)).alias("mae"),
               F.avg(F.when(y != 0, F.abs(e / y))).alias("_mape"),
               F.var_pop(y).alias("_var"), F.count(y).alias("_ny"))
    sst = F.col("_var") * F.col("_ny")  # centred sums: large labels do not cancel
    return s.select("n", F.sqrt(F.try_divide(F.col("_sse"), F.col("n"))).alias("rmse"), "mae",
                    (F.col("_mape") * 100).alias("mape"),
                    (1 - F.try_divide(F.col("_sse"), sst)).alias("r2"))


def business_cost(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """ml17: mean of 1*max(0, pred - y) + 3*max(0, y - pred), with RMSE, MAE."""
    y, p = F.col(label), F.col(pred)
    cost = OVERSTOCK_COST * F.greatest(p - y, F.lit(0.0)) + UNDERSTOCK_COST * F.greatest(y - p, F.lit(0.0))
    return df.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
                  F.avg(F.abs(y - p)).alias("mae"), F.avg(cost).alias("business_cost"))


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ml16: exact ROC AUC of a score (ties count one half), and
    ``auc_hard_label`` = (TPR + TNR) / 2 when ``score`` is a 0/1 prediction."""
    g = df.groupBy(F.col(score).alias("_s")).agg(F.count_if(F.col(label) == 1).alias("_p"),
                                                 F.count_if(F.col(label) == 0).alias("_q"))
    # Exclusive prefix sum of negatives in score order, computed distributed.
    ranked = _prefix_sum(g, "_s", "_q", "_q_below")
    s = ranked.agg(F.sum(F.col("_p") * (F.col("_q_below") + 0.5 * F.col("_q"))).alias("_u"),
                   F.sum("_p").alias("n_pos"), F.sum("_q").alias("n_neg"))
    den = F.col("n_pos") * F.col("n_neg")
    return s.select("n_pos", "n_neg", F.when(den > 0, F.col("_u") / den).alias("auc"))


def _prefix_sum(df: DataFrame, order_col: str, value_col: str, out_col: str) -> DataFrame:
    """Exclusive prefix sum of ``value_col`` in ``order_col`` order (unique
    keys), via range partitioning and per-partition totals."""
    spark = df.sparkSession
    nparts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = (df.repartitionByRange(nparts, order_col).sortWithinPartitions(order_col)
               .withColumn("_pid", F.spark_partition_id()))
    ordered = stable(ordered)  # one partition assignment for both uses
    w_in = Window.partitionBy("_pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    # Within a partition the window is over that partition's rows only.
    local = ordered.withColumn("_local", F.coalesce(F.sum(value_col).over(w_in), F.lit(0)))
    tot = ordered.groupBy("_pid").agg(F.sum(value_col).alias("_tot"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.withColumn("_off", F.coalesce(F.sum("_tot").over(w), F.lit(0))).select("_pid", "_off")
    return (local.join(F.broadcast(offs), "_pid")
            .withColumn(out_col, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off"))


def hard_label_auc(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """ml16 (D4): AUC of hard 0/1 predictions = (TPR + TNR) / 2."""
    s = df.agg(F.count_if((F.col(label) == 1) & (F.col(pred) == 1)).alias("tp"),
               F.count_if(F.col(label) == 1).alias("p"),
               F.count_if((F.col(label) == 0) & (F.col(pred) == 0)).alias("tn"),
               F.count_if(F.col(label) == 0).alias("q"))
    return s.select(((F.try_divide(F.col("tp"), F.col("p")) + F.try_divide(F.col("tn"), F.col("q"))) / 2)
                    .alias("auc_hard_label"))
