"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every cumulus job relies on.  AQE re-plans joins from runtime sizes
# (broadcast when a shuffled side turns out small, splits skewed partitions);
# dynamic partition overwrite lets a history append replace only the
# partitions it writes.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "cumulus", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the cumulus defaults.

    On a cluster leave ``master`` unset so spark-submit decides; the shuffle
    partition count should then be sized to the data (≈128–256 MB per task).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and derived tables.

    Read from ``spark.checkpoint.dir``.  Only when the session has none and
    runs in local mode (tests) is a private folder created and registered as
    the checkpoint dir; on a cluster a machine-local folder would be lost with
    its executor, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder "
                               "every executor shares (HDFS, S3, ABFS, GCS, NFS)")
        base = tempfile.mkdtemp(prefix="cumulus-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared dir for one derived table.

    All of an application's lie in one folder, which its file system removes
    when the driver's JVM ends."""
    sc = spark.sparkContext
    top = f"{shared_dir(spark)}/cumulus/{sc.applicationId}"
    p = sc._jvm.org.apache.hadoop.fs.Path(top)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{top}/{name}/{uuid.uuid4().hex}"
