"""shipcast: shipment-order analytics on Spark.

Layout
------
sources/    scans (Parquet, CSV), the ``shipments`` order view, sinks
functions/  column-expression helpers (null rules, rounding, families)
operators/  DataFrame -> DataFrame operators (profile, correlate, clean,
            features, encode, split, metrics, models)
plans/      composed runs: preprocessing pipeline, model tasks, and the
            query catalog used by ``__spark_entry__``
"""

from shipcast.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
