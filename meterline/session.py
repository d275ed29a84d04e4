"""SparkSession helpers shared by tests, bench and the entry module."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so second arithmetic and date
# formatting are stable, AQE so joins and skewed partitions are re-planned
# from runtime sizes, and no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(app: str = "meterline", cpus: int | str = "*",
              shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and bench; on a cluster use the provided session."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("METERLINE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing (e.g. cluster) session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only a local session without it gets a scratch folder,
    which goes when the process ends; on a cluster a folder that executors
    can't see would lose rows, so that raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="meterline-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid
    return f"{base}/meterline-tables/{name}-{uuid.uuid4().hex[:12]}"
