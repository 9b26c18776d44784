"""Sinks: raw and processed splits, test ids, correlation matrix, predictions,
metrics, models.  Writers are distributed (one file per task partition);
nothing is funnelled through the driver or a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.functions.columns import vector_cells
from shipcast.session import scratch_path


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder."""
    return scratch_path(spark, name)


def write_csv(df: DataFrame, path: str, partition_by: str | None = "split",
              mode: str = "overwrite") -> str:
    """io04 / io06: header CSV; ``partition_by`` lays splits out as folders so
    a later read of one split prunes the other."""
    w = df.write.mode(mode).option("header", True)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: str | None = "split",
                  mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def write_splits_csv(train: DataFrame, test: DataFrame, path: str) -> str:
    """io04: both splits under one folder, partitioned by ``split``."""
    both = (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))
    return write_csv(both, path)


def write_test_ids(test: DataFrame, path: str) -> str:
    """io05: the test split's ``order_id`` column."""
    return write_csv(test.select("order_id"), path, partition_by=None)


def write_predictions(scored: DataFrame, path: str) -> str:
    """io09: (order_id, prediction)."""
    return write_csv(scored.select("order_id", "prediction"), path, partition_by=None)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """io10: the metrics table as JSON lines (one object per model)."""
    metrics.write.mode("overwrite").json(path)
    return path


#: The metrics document of one task.
DOCUMENT = ("task string, best_model string, best_params map<string,string>, "
            "results map<string,struct<cv_metric:double,params:map<string,string>,metrics:map<string,double>>>")


def write_metrics_document(spark: SparkSession, path: str, task: str, best: str, results: dict) -> str:
    """io10: one nested JSON document (best model, its parameters, every model's
    results); it appears whole or not at all, by the committer's rename."""
    def text(params):
        return {k: str(v) for k, v in params.items()}

    rows = {m: (x["cv_metric"], text(x["params"]), x["metrics"]) for m, x in results.items()}
    one = spark.createDataFrame([(task, best, text(results[best]["params"]), rows)], DOCUMENT)
    one.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metrics_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).json(path)


def vector_text(col: str) -> F.Column:
    """A vector as ``slot:value`` pairs of its non-zero entries, slots from 1, ascending."""
    return F.array_join(F.transform(vector_cells(col), lambda c: F.concat(
        c["slot"].cast("string"), F.lit(":"), c["value"].cast("string"))), " ")


def write_processed(df: DataFrame, names: DataFrame, path: str) -> str:
    """io06: processed rows of both splits as CSV partitioned by ``split``, vectors as
    ``slot:value`` text, and the table of feature names (column, slot, name) beside them."""
    from pyspark.ml.linalg import VectorUDT
    flat = df.select(*[vector_text(f.name).alias(f.name) if isinstance(f.dataType, VectorUDT) else F.col(f.name)
                       for f in df.schema.fields])
    write_csv(flat, f"{path}/rows")
    write_csv(names, f"{path}/names", partition_by=None)
    return path


def read_processed(spark: SparkSession, path: str, schema) -> DataFrame:
    """``write_processed``'s rows with numbers as in ``schema`` and vectors as slot -> value maps."""
    from pyspark.ml.linalg import VectorUDT
    plain = [f for f in schema.fields if not isinstance(f.dataType, VectorUDT)]
    vectors = [f.name for f in schema.fields if isinstance(f.dataType, VectorUDT)]
    rows = spark.read.option("header", True).csv(f"{path}/rows")
    def cells(name):
        pairs = F.transform(F.filter(F.split(F.coalesce(name, F.lit("")), " "), lambda x: x != ""), lambda x: F.split(x, ":"))
        return F.map_from_arrays(F.transform(pairs, lambda x: x[0].cast("int")), F.transform(pairs, lambda x: x[1].cast("double")))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in plain], *[cells(n).alias(n) for n in vectors])


def save_model(model, path: str) -> str:
    """io11: persist a fitted ``PipelineModel`` (or any MLWritable)."""
    model.write().overwrite().save(path)
    return path
