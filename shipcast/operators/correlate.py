"""Pairwise-complete Pearson correlation (pandas ``DataFrame.corr``).

Plan: one Gram pass.  Values are centred on their column's mean (one narrow
aggregate, which also keeps large sums from cancelling), each batch of rows
becomes a matrix with a 0/1 mask of what is present, and four products give the
count, sums, squares and cross products of every pair over its complete rows.
A task emits one row per pair whatever its rows, so the shuffle carries
(pairs x tasks) rows; no row is exploded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.functions.columns import numeric_columns

KEY = "order_id"
# The dashboard's default variables.
KEY_VARIABLES = ("supplier_risk_score", "realistic_total_cost", "optimal_stock_days", "will_be_delayed")


def corr_pairs(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """co02: (i, j, var1, var2, correlation, abs_corr) for i < j in column
    order.  A constant column, or a pair with < 2 complete rows, gives NULL."""
    cols = list(cols) if cols else numeric_columns(df, exclude=[KEY])
    if len(cols) < 2:
        raise ValueError("correlation needs at least two numeric columns")
    k = len(cols)
    names = F.array(*[F.lit(c) for c in cols])
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    means = values.agg(*[F.avg(F.nanvl(f"c{i}", F.lit(None))).alias(f"m{i}") for i in range(k)])
    centred = values.crossJoin(F.broadcast(means)).select(
        *[(F.col(f"c{i}") - F.col(f"m{i}")).alias(f"c{i}") for i in range(k)])

    def gram(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for rb in it:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in rb.columns], 1)
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            sums, squares = x.T @ there, (x * x).T @ there
            total += np.stack([there.T @ there, sums, sums.T, squares, squares.T, x.T @ x])
        i, j = np.triu_indices(k, 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          *(pa.array(t[i, j]) for t in total)], ["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    g = centred.mapInArrow(gram, "i int, j int, n double, x double, y double, xx double, yy double, xy double")
    g = g.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    # Sums of centred values: what rounding leaves of a constant column counts as no variance.
    spread = lambda s, ss: F.when(F.col("n") > 1, F.col(ss) - F.col(s) * F.col(s) / F.col("n")).otherwise(0.0)
    root = lambda s, ss: F.when(spread(s, ss) > F.col(ss) * 1e-14, F.sqrt(spread(s, ss))).otherwise(0.0)
    g = g.select("i", "j", F.when(F.col("n") > 1, F.col("xy") - F.col("x") * F.col("y") / F.col("n")).alias("_c"),
                 root("x", "xx").alias("_sx"), root("y", "yy").alias("_sy"))
    den = F.col("_sx") * F.col("_sy")
    r = F.when(den > 0, F.least(F.greatest(F.col("_c") / den, F.lit(-1.0)), F.lit(1.0)))
    return g.select("i", "j", F.element_at(names, F.col("i") + 1).alias("var1"),
                    F.element_at(names, F.col("j") + 1).alias("var2"),
                    r.alias("correlation"), F.abs(r).alias("abs_corr"))


def corr_matrix_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """co01: the full matrix in long form (var1, var2, correlation): both
    triangles plus the diagonal (1 for a column with variance, else NULL)."""
    cols = list(cols) if cols else numeric_columns(df, exclude=[KEY])
    p = corr_pairs(df, cols)
    # Mirror each pair from the single aggregate (no second pass over rows).
    both = p.select(F.inline(F.array(
        F.struct(F.col("var1").alias("var1"), F.col("var2").alias("var2"), F.col("correlation")),
        F.struct(F.col("var2").alias("var1"), F.col("var1").alias("var2"), F.col("correlation")))))
    var = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("var1"), F.col(c).alias("_v")) for c in cols])
    diag = var.select(F.inline(pairs)).select(
        "var1", F.col("var1").alias("var2"),
        F.when(F.nanvl(F.col("_v"), F.lit(0.0)) > 0, F.lit(1.0)).alias("correlation"))
    return both.unionByName(diag)


def corr_matrix_wide(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """io08 input: one row per variable, one column per variable."""
    cols = list(cols) if cols else numeric_columns(df, exclude=[KEY])
    long = corr_matrix_long(df, cols)
    return (long.groupBy("var1").pivot("var2", cols).agg(F.first("correlation"))
            .withColumnRenamed("var1", "variable"))


def top_pairs(df: DataFrame, cols: Sequence[str] | None = None, k: int = 15) -> DataFrame:
    """so02: the ``k`` pairs with the largest |r| (NULLs last, ties by position)."""
    return (corr_pairs(df, cols).orderBy(F.col("abs_corr").desc_nulls_last(), "i", "j")
            .limit(k).select("var1", "var2", "correlation", "abs_corr"))
