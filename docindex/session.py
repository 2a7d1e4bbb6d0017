"""Session helpers: a tuned local session for tests and a shared checkpoint root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and coalesces or splits
# skewed shuffle partitions at runtime; UTC keeps timestamps stable.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "docindex", extra: dict | None = None) -> SparkSession:
    """Session for tests and benchmarks. On a cluster, use the cluster's own session."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    Uses the session's ``spark.checkpoint.dir`` (or the SparkContext's checkpoint
    dir). Only a local-mode session without one gets a fresh temporary folder;
    a cluster session without one is an error, because a machine-local folder is
    not visible to other executors and does not survive their loss.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            root = tempfile.mkdtemp(prefix="docindex-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new, unique path under the checkpoint root for one materialised table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{kind}-{uuid.uuid4().hex}"
