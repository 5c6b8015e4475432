"""Session helpers.

On a cluster the session comes from the launcher; these helpers only fill in
what is missing (tests, bench, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlens") -> SparkSession:
    """A session with the defaults above where the launcher (spark-submit, properties) sets none."""
    given = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("LEDGERLENS_MASTER") or (None if given.contains("spark.master") else "local[8]")
    if master:
        builder = builder.master(master)
    for k, v in LOCAL_CONF.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is.  Only when nothing is configured (local tests) a fresh scratch
    folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Only for local runs and tests: nothing names a shared folder.
        configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
