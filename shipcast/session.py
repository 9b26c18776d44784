"""Session construction and the shared working folder.

On a cluster the folder for checkpoints and intermediate tables is whatever
``spark.checkpoint.dir`` names; we never invent one there.  Only when the
setting is absent (local tests, the bench) do we point it at a fresh folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session should carry; cluster-specific sizing
# (executor memory, shuffle partitions at scale) is left to the deployer.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "shipcast", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the engine's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Runtime SQL settings may not have applied if a session already existed.
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for checkpoints and written tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint folder).  Only a
    local master gets a fresh folder of its own when neither exists; a cluster
    must name one, since executors cannot share the driver's local disk.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path and not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="shipcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder for a written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def lasting_dir(spark: SparkSession) -> str:
    """The shared folder itself rather than this application's part of it: what is
    written here is found again by the next application."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or shared_dir(spark)).rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
