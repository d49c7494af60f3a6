"""Session helpers: building a session and finding the shared scratch folder.

Lineage cuts and intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``. A folder of our own is only chosen when that setting
is missing *and* Spark runs in local mode (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # drop reliable checkpoints once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (pass as ``extra_conf``). Shuffle
# partitions are set high and left to AQE to coalesce toward the advisory
# size; skewed join partitions are split; files are read in 256 MB splits.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # smaller snapshots for the same read speed
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "abode",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master.startswith("local"):
        conf["spark.driver.host"] = "127.0.0.1"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting it if needed.

    Order: the folder already active on the context, then the
    ``spark.checkpoint.dir`` setting, then (local mode only) a fresh folder
    under the system temp dir. On a cluster without the setting this raises:
    a machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by the cluster"
            )
        configured = tempfile.mkdtemp(prefix="abode-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path below the shared checkpoint folder.

    Its folder is removed when the session's JVM ends: results that read it are lazy, so not before.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{base}/abode-scratch/{uuid.uuid4().hex}"
    if hasattr(spark, "_jvm"):  # a remote session has none
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(place)
        fs.deleteOnExit(place)
    return f"{folder}/{name}"
