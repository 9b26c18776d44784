"""Group-mean baseline predictor: the train mean of the label per key group,
falling back to the global train mean for NULL or unseen keys.

It is the constant-per-segment reference every tuned model must beat, and a
deterministic source of predictions for checking the metric operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_group_mean(train: DataFrame, label: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    keys = list(keys)
    glob = train.agg(F.avg(label).alias("_gmean"))
    if not keys:
        return None, glob
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    grp = train.where(cond).groupBy(*keys).agg(F.avg(label).alias("_kmean"))
    return grp, glob


def predict_group_mean(df: DataFrame, state: tuple[DataFrame, DataFrame], keys: Sequence[str],
                       out: str = "prediction") -> DataFrame:
    grp, glob = state
    j = df.crossJoin(F.broadcast(glob))
    if grp is not None:
        # Group table: no hint; AQE broadcasts it after measuring it.
        j = j.join(grp, list(keys), "left")
        pred = F.coalesce(F.col("_kmean"), F.col("_gmean"))
    else:
        pred = F.col("_gmean")
    return j.select(*[F.col(c) for c in df.columns], pred.alias(out))
