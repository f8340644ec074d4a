"""Session helpers for tests, the bench and local runs.

On a cluster the caller's session is used as is; nothing here overrides
settings the cluster already made (checkpoint dir in particular).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName("lapse")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, setting a scratch one only on a local master.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always kept.  Without one, a local session gets a fresh temp folder, and any
    other master raises: executors could not read a machine-local folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors share (master {sc.master})")
    path = tempfile.mkdtemp(prefix="lapse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scratch_folder(spark: SparkSession, stem: str) -> str:
    """A fresh path in the shared checkpoint folder, removed by the file system when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{stem}-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(conf).deleteOnExit(hadoop_path)
    return path
