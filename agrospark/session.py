"""Session helpers.

Library code never creates a session; it receives one.  ``local_session`` is
for tests and the bench only.  ``checkpoint_dir`` reads the shared folder the
cluster names in ``spark.checkpoint.dir`` and only falls back to a scratch
folder when the session runs in local mode and the setting is absent.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "agrospark") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system); a machine-local temporary folder is only used in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a "
                "shared checkpoint folder on a cluster")
        conf = tempfile.mkdtemp(prefix="agrospark-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/agrospark-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing a parquet table in the shared checkpoint folder
    and reading it back (never ``localCheckpoint``): the result survives the
    loss of any executor, and the downstream plan starts from a columnar
    scan instead of the whole upstream plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over the cluster by a hash of ``keys``, for rows that are much work
    each: a small file is read by one task, and an exchange that an earlier step
    leaves is coalesced by its size, not by its work."""
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, F.xxhash64(*keys))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
