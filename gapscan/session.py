"""Session helpers.

On a cluster the session comes from ``spark-submit``; these helpers only fill
in settings that are not set yet, so cluster configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings this engine relies on. AQE re-plans joins at run time: it turns a
# sort-merge join into a broadcast join when the measured side is small, and
# splits a skewed partition of a sort-merge join across several tasks.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "gapscan", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (not for cluster use)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", memory)
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    used as is. Only a local session (tests, the bench) gets a scratch folder
    when none is set; on a cluster a missing setting is an error, because a
    machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
        path = tempfile.mkdtemp(prefix="gapscan-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
