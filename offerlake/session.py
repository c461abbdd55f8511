"""Session construction and cluster-aware settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session gets; values sized for local tests, overridden by the cluster's own config when present.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "offerlake") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session instead."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("OFFERLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    # A local session owns its scratch checkpoint folder; cluster sessions come with spark.checkpoint.dir set.
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="offerlake-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read; if it is missing there, that is an error, as the
    driver's own disk is no place for checkpoints. Only a local session gets a scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns spark.checkpoint.dir
        return spark.conf.get("spark.checkpoint.dir", "")
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not path:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="offerlake-ckpt-")
    sc.setCheckpointDir(path)
    return path
