"""Deterministic splits, folds and class weights (ml01-ml04, ml06).

Rows are ordered by ``md5(CAST(order_id AS STRING)), order_id`` - a shuffle
that is identical in every engine and on every re-run - and cut by rank:

* hold-out: the first ``ceil(0.2 n)`` rows of the order (per label when
  stratified) are validation;
* folds: ``rank % k`` (per label when stratified).

Ranks come from ``rank_rows``: a range-partitioned sort followed by
per-partition counts, so no window ever spans all rows of a label in one
task.  The only thing joined back is the per-(partition, group) offset table,
whose size is bounded by partitions x groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipcast.operators.quantiles import stable

KEY = "order_id"
VALIDATION_SHARE = 0.2
N_FOLDS = 5


def shuffle_key(key: str = KEY):
    return F.md5(F.col(key).cast("string"))


def rank_rows(df: DataFrame, order: Sequence, by: Sequence[str] = (),
              rank_col: str = "_rank", size_col: str = "_n") -> DataFrame:
    """Add a 0-based rank of each row within its ``by`` group under ``order``
    (which must be a total order, e.g. end with a unique key) and the group
    size.  Distributed: range partitioning + per-partition counts."""
    spark = df.sparkSession
    nparts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    by = list(by)
    ocols = [f"_o{i}" for i in range(len(order))]
    base = df.select("*", *[(F.col(o) if isinstance(o, str) else o).alias(n) for o, n in zip(order, ocols)])
    ordered = (base.repartitionByRange(nparts, *by, *ocols)
               .sortWithinPartitions(*by, *ocols)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = stable(ordered)  # numbered once; both uses read the same rows
    parts = ordered.groupBy("_pid", *by).agg(F.min("_mid").alias("_base"), F.count(F.lit(1)).alias("_cnt"))
    wg = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    # The window runs over the small offset table (partitions x groups rows).
    parts = (parts.withColumn(size_col, F.sum("_cnt").over(wg))
             .withColumn("_start", F.sum("_cnt").over(wg.orderBy("_pid")) - F.col("_cnt")))
    # Written (partitions x groups rows), so that the planner broadcasts it if its bytes allow.
    j = ordered.join(stable(parts), ["_pid", *by])
    out = j.withColumn(rank_col, F.col("_start") + F.col("_mid") - F.col("_base"))
    return out.drop("_pid", "_mid", "_base", "_cnt", "_start", *ocols)


def holdout(df: DataFrame, label: str | None = None, share: float = VALIDATION_SHARE,
            key: str = KEY) -> DataFrame:
    """ml01 (no label) / ml02 (stratified by ``label``): adds ``is_val``."""
    by = [label] if label else []
    r = rank_rows(df, [shuffle_key(key), F.col(key)], by)
    n_val = F.ceil(F.col("_n") * F.lit(share))
    return r.withColumn("is_val", (F.col("_rank") < n_val).cast("int")).drop("_rank", "_n")


def kfold(df: DataFrame, label: str | None = None, k: int = N_FOLDS, key: str = KEY) -> DataFrame:
    """ml03 (no label) / ml04 (stratified): adds ``fold`` in 0..k-1."""
    by = [label] if label else []
    r = rank_rows(df, [shuffle_key(key), F.col(key)], by)
    return r.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank", "_n")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """ml06: balanced weights ``n / (k * n_c)`` per class and, for a 0/1
    label, the positive-class weight ``n_neg / n_pos``."""
    from pyspark.sql import types as T
    c = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy(F.lit(0))  # over the per-class counts only
    c = c.withColumn("_n", F.sum("n_class").over(w)).withColumn("_k", F.count(F.lit(1)).over(w))
    out = [label, "n_class",
           (F.col("_n").cast("double") / (F.col("_k") * F.col("n_class"))).alias("balanced_weight")]
    if isinstance(df.schema[label].dataType, T.NumericType):
        c = (c.withColumn("_neg", F.sum(F.when(F.col(label) == 0, F.col("n_class"))).over(w))
             .withColumn("_pos", F.sum(F.when(F.col(label) == 1, F.col("n_class"))).over(w)))
        out.append(F.when(F.col("_pos") > 0, F.col("_neg").cast("double") / F.col("_pos")).alias("pos_weight"))
    return c.select(*out)


def with_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class (tiny per-class table)."""
    w = class_weights(df, label).select(label, F.col("balanced_weight").alias(weight_col))
    return df.join(F.broadcast(w), label, "left")
