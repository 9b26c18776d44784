"""pp01: the preprocessing pipeline, in the reference's fixed order:
drop -> repair -> winsorize -> impute -> features -> log + scale -> encode.

The steps are the fitted stages of ``operators/stages.py``: statistics come from
the ``train`` rows only, and one ``PipelineModel`` applies them to both splits in
one projection with joins to the small state tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.operators.quantiles import stable
from shipcast.operators.stages import fit_preprocessing

KEY = "order_id"
SPLIT = "split"


def run_pipeline(df: DataFrame, task: str = "all") -> DataFrame:
    """All rows of ``df`` (with ``split``) processed for ``task``; keeps
    ``order_id`` and ``split`` as side keys."""
    return stable(fit_preprocessing(df.where(F.col(SPLIT) == "train"), task).transform(df))


def null_report(processed: DataFrame) -> DataFrame:
    """pp01 report: rows and total NULL cells per split."""
    cols = [c for c in processed.columns if c != SPLIT]
    nulls = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0))
    return processed.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(nulls).alias("null_cells"))
