"""Spark session helpers.

The library itself never creates a session: every builder takes DataFrames (or a
session) from the caller. These helpers are for scripts, tests and the benchmark.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans joins from runtime
# sizes (a join side is broadcast only when its measured size is under the
# threshold), splits skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_STAGED: set[str] = set()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "stationlake", driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The cluster names it.  Only a local master without the setting gets a folder of its own
    (removed when Python ends); on a cluster a machine-local folder would be a different one on
    every executor, so a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="stationlake-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables (one folder an
    application: removed by :func:`remove_staged`, and when Python ends if it is on a file system
    that the driver sees)."""
    top = os.path.join(ensure_checkpoint_dir(spark), "stationlake", spark.sparkContext.applicationId)
    seen = re.sub(r"^file:/+", "/", top)
    if seen.startswith("/") and seen not in _STAGED:
        _STAGED.add(seen)
        atexit.register(shutil.rmtree, seen, ignore_errors=True)
    return os.path.join(top, name)


def remove_staged(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application: call it before the session stops."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
