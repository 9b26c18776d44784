"""Column-level helpers that carry the workload's null and number rules.

All helpers return Catalyst expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_DATETIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric family: integer, long, float, double, decimal (never boolean)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _DATETIME)]


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Keep the names that exist in ``df`` (the schema-tolerant guard)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every float/double column, so averages skip it."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            exprs.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def clip(c: Column, lo: Column, hi: Column) -> Column:
    """Clip that keeps NULL as NULL (``least``/``greatest`` alone would fill it)."""
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(F.least(c, hi), lo))


def flag(cond: Column) -> Column:
    """0/1 integer of a predicate; a NULL comparison counts as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def rnd(c: Column | str, digits: int) -> Column:
    """Round a double for reporting (half away from zero, as SQL ``round``)."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def pct_round2(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` rounded half-up to 2 decimals, in exact integer
    arithmetic so every engine returns the same double."""
    num = part.cast("long") * F.lit(20000) + whole.cast("long")
    den = whole.cast("long") * F.lit(2)
    # (num - num % den) is an exact multiple of den, so the division is exact.
    hundredths = ((num - num % den) / den).cast("long")
    return F.when(whole > 0, hundredths / F.lit(100.0))


_VECTOR = "v struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def _stored(col: str) -> Column:
    """The fields of an ML vector column as they are stored."""
    return F.from_json(F.to_json(F.struct(F.col(col).alias("v"))), _VECTOR)["v"]


def vector_size(col: str) -> Column:
    """Number of slots of an ML vector column."""
    return F.coalesce(_stored(col)["size"], F.size(_stored(col)["values"]))


def vector_cells(col: str) -> Column:
    """The non-zero entries of an ML vector column as structs (slot from 1, value), by
    slot.  A sparse vector is never made dense: a row costs its entries, not its slots."""
    v = _stored(col)
    slots = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    cells = F.zip_with(slots, v["values"], lambda i, x: F.struct((i + 1).alias("slot"), x.alias("value")))
    return F.filter(cells, lambda c: c["value"] != 0)
