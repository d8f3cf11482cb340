"""Spark session helpers.

On a cluster the session is created by the platform; we only read settings
from it.  ``spark.checkpoint.dir`` names the shared folder used for lineage
cuts and intermediate tables.  A local default is set only when the setting is
absent (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "mapfold", **conf) -> SparkSession:
    """Session for local runs and tests; an existing session is reused."""
    builder = SparkSession.builder.appName(app)
    if master is None:
        master = os.environ.get("MAPFOLD_MASTER", "local[8]")
    builder = builder.master(master)
    for k, v in {**_LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a local one is made only for a
    local master, because on a cluster executors do not share it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="mapfold-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
