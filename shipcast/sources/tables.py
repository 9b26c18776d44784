"""Scans of the driver tables and of split files (Parquet, CSV)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipcast.functions.columns import nan_to_null

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

DATE_COLUMNS = ("order_date", "order_timestamp")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def coerce_timestamps(df: DataFrame, cols=DATE_COLUMNS) -> DataFrame:
    """io03: text or timestamp date columns -> zone-free timestamps, when present."""
    out = df
    for c in cols:
        if c in df.columns:
            dt = df.schema[c].dataType
            if isinstance(dt, T.TimestampNTZType):
                continue
            if isinstance(dt, (T.TimestampType, T.DateType)):
                out = out.withColumn(c, F.col(c).cast(T.TimestampNTZType()))
            else:
                out = out.withColumn(c, F.to_timestamp_ntz(F.col(c)))
    return out


def load_parquet_splits(spark: SparkSession, train_path: str, test_path: str):
    """io01: (train, test) from Parquet, NaN normalised to NULL; (None, None)
    when either path cannot be read, as the reference loader does."""
    try:
        train = spark.read.parquet(train_path)
        test = spark.read.parquet(test_path)
    except AnalysisException:
        return None, None
    return nan_to_null(coerce_timestamps(train)), nan_to_null(coerce_timestamps(test))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """io02: header CSV with an explicit schema (inference costs a full extra
    pass at scale); date columns arrive as text and are coerced (io03)."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return nan_to_null(coerce_timestamps(reader.csv(path)))


def load_csv_splits(spark: SparkSession, train_path: str, test_path: str,
                    schema: T.StructType | None = None):
    """io02: (train, test) from CSV; (None, None) when a path cannot be read."""
    try:
        return read_csv(spark, train_path, schema), read_csv(spark, test_path, schema)
    except AnalysisException:
        return None, None


def text_schema(schema: T.StructType, text_cols=DATE_COLUMNS) -> T.StructType:
    """The CSV reading schema: same fields, with the date columns as strings."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name in text_cols else f.dataType, True)
        for f in schema.fields])
