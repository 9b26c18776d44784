"""Scaling and encoding: standard scaling, one-hot, column alignment, labels.

* Scaling fits mean and *population* std on train in one aggregate (one row,
  broadcast); a constant column divides by 1.  ``pyspark.ml``'s
  ``StandardScaler`` uses the sample std and maps constants to 0, so it is not
  used.
* One-hot has one form for every vocabulary size: each column becomes one
  sparse vector over its sorted train values but the first, with the values as
  the column's ML attributes, so train and test always get the same slots.
  ``StringIndexer`` (alphabetical, descending; the first value is no label, so it
  shares the last index with unseen and NULL values) and ``OneHotEncoder`` (which
  drops that index) run JVM-side, one pass for all columns; a row costs the same
  whatever the vocabulary's size.
  ``one_hot_long`` gives the same encoding as (key, feature) rows by a join with
  the vocabulary table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.functions.columns import numeric_columns
from shipcast.operators.quantiles import stable

KEY = "order_id"

# The categorical columns the encoder looks for.
CATEGORICAL = ("product_category", "formulation", "temperature_requirement", "manufacturing_site",
               "distribution_center", "api_supplier", "excipient_supplier", "packaging_supplier",
               "shipping_mode", "geopolitical_risk", "market_region", "therapeutic_area_priority",
               "day_of_week", "quarter", "month")
RISK_LABELS = {"Low_Risk": 0, "Medium_Risk": 1, "High_Risk": 2}


def model_input(df: DataFrame, key: str = KEY) -> DataFrame:
    """io07: keep the key and the numeric family; string and datetime columns
    (as found in this frame's schema) are dropped."""
    cols = numeric_columns(df, exclude=[key])
    return df.select(*([key] if key in df.columns else []), *cols)


# ---------------------------------------------------------------- scaling

def fit_scaler(train: DataFrame, cols: Sequence[str] | None = None,
               exclude: Sequence[str] = (KEY,)) -> DataFrame:
    """One row: ``{c}__mean`` and ``{c}__std`` (population) per column."""
    cols = list(cols) if cols else numeric_columns(train, exclude=exclude)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return train.agg(*aggs)


def apply_scaler(df: DataFrame, state: DataFrame) -> DataFrame:
    """nm01: ``(x - mean) / std`` with std 0 -> 1; a fitted column missing
    from df is created as 0 first.  NULL stays NULL."""
    cols = [c[:-6] for c in state.columns if c.endswith("__mean")]
    base = df
    for c in cols:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(0.0))
    j = base.crossJoin(F.broadcast(state))
    out = []
    for c in base.columns:
        if c in cols:
            std = F.col(f"{c}__std")
            den = F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std)
            out.append(((F.col(c) - F.col(f"{c}__mean")) / den).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


# ---------------------------------------------------------------- one-hot

def _present(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return [c for c in (cols or CATEGORICAL) if c in df.columns]


def fit_one_hot(train: DataFrame, cols: Sequence[str] | None = None) -> tuple[list[str], list]:
    """(columns, fitted stages): the stages turn every categorical string column ``c``
    into the sparse vector ``c_vec`` over train's sorted values but the first."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel
    cols = _present(train, cols)
    if not cols:
        return [], []
    known = train.select(*[F.col(c).cast("string").alias(c) for c in cols])
    values = StringIndexer(inputCols=cols, outputCols=[f"{c}__idx" for c in cols], stringOrderType="alphabetDesc",
                           handleInvalid="keep").fit(known).labelsArray
    # A column of fewer than two values has one slot, of a label that is none of them.
    index = [StringIndexerModel.from_labels(list(v[:-1]) or [f"{''.join(v)}\0"], inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep")
             for c, v in zip(cols, values)]
    # The sizes come from the indexers' labels, so no pass over the data is needed here.
    few = known.limit(1)
    for stage in index:
        few = stage.transform(few)
    encode = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}_vec" for c in cols]).fit(few)
    return cols, [*index, encode]


def feature_names(stages, spark) -> DataFrame:
    """(column, slot from 1, name) of every slot of the one-hot vectors of fitted stages
    that stands for a value."""
    from pyspark.ml.feature import StringIndexerModel
    rows = [(f"{s.getInputCol()}_vec", k + 1, value) for s in stages if isinstance(s, StringIndexerModel)
            for k, value in enumerate(s.labels) if not value.endswith("\0")]
    return spark.createDataFrame(rows, "column string, slot int, name string")


def one_hot(train: DataFrame, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """en01: replace each categorical column ``c`` by the sparse vector ``c_vec``
    over train's sorted values but the first; NULL or an unseen value gives all
    zeros.  A column of fewer than two train values gives a vector of one zero."""
    cols, stages = fit_one_hot(train, cols)
    out = df.select(*[c for c in df.columns if c not in cols], *[F.col(c).cast("string").alias(c) for c in cols])
    for stage in stages:
        out = stage.transform(out)
    return out.drop(*[x for c in cols for x in (c, f"{c}__idx")])


def _stacked(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., col, val) rows of the non-NULL values."""
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val")) for c in cols])
    return df.select(*keys, F.inline(cells)).where(F.col("val").isNotNull())


def vocabulary(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, val): the distinct values of each column but the first, as a
    written table, so that the planner knows its bytes when it joins it."""
    values = _stacked(train, cols).distinct()
    first = values.groupBy("col").agg(F.min("val").alias("first"))
    return stable(values.join(first, "col").where("val <> first").select("col", "val"))


def one_hot_long(train: DataFrame, df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """en01 as rows: (keys..., feature) for every one of the encoding."""
    rows = _stacked(df, _present(train, cols), keys).join(vocabulary(train, _present(train, cols)), ["col", "val"])
    return rows.select(*keys, F.concat_ws("_", "col", "val").alias("feature"))


def align_columns(reference: DataFrame, other: DataFrame, fill=0) -> DataFrame:
    """en02: give ``other`` exactly the columns of ``reference``, in its
    order; columns it lacks are added as ``fill``; extra ones are dropped."""
    have = set(other.columns)
    return other.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in reference.columns])


# ---------------------------------------------------------------- labels

def encode_labels(df: DataFrame, col: str = "supply_chain_disruption_risk",
                  out: str = "label", mapping: dict = RISK_LABELS) -> DataFrame:
    """en03: class names to 0/1/2 (a fixed order, not frequency order)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out, m[F.col(col)])


def decode_labels(df: DataFrame, col: str = "prediction", out: str = "prediction",
                  mapping: dict = RISK_LABELS) -> DataFrame:
    """en03 inverse: 0/1/2 back to class names."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(float(v)), F.lit(k))])
    return df.withColumn(out, m[F.col(col).cast("double")])
