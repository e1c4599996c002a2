"""Session settings and the shared scratch location.

Every job reads its scratch root from ``spark.checkpoint.dir`` (the shared folder a
cluster names there).  Only with a local master, and only when that is unset, do we pick a
private temporary folder and register it as the checkpoint directory; on a cluster an unset
root is an error, because executors don't see each other's disks.  A session's scratch folder
is deleted when its JVM ends.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Scratch folders that this process has made and marked for deletion.
_HOMES: set[str] = set()


def get_session(master: str | None = None, app: str = "snaplake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared scratch root: ``spark.checkpoint.dir`` if the cluster names one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # Unset (local tests only): register a private folder once.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="snaplake-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the session's part of the shared scratch root."""
    sc = spark.sparkContext
    home = f"{checkpoint_root(spark)}/snaplake/{sc.applicationId}"
    if home not in _HOMES:
        path = sc._jvm.org.apache.hadoop.fs.Path(home)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _HOMES.add(home)
    return f"{home}/{name}-{uuid.uuid4().hex[:12]}"
