"""Spark session helpers.

The library never hard-codes a cluster layout. ``get_spark`` is a convenience for
local runs and tests; on a cluster the caller passes its own session and the
library only reads settings from it (``checkpoint_dir``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on for correct results (UTC dates) and for plans
# that hold at scale (AQE re-planning, skew-join splitting, partition coalescing).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "starloom") -> SparkSession:
    """Build (or reuse) a session with the library defaults applied."""
    master = master or os.environ.get("STARLOOM_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when
    neither is set — local runs and tests — a private temporary folder is created
    and registered, so ``DataFrame.checkpoint()`` works as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")
