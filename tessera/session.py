"""Session and scratch-space helpers.

Library code never creates its own cluster settings: it reads what the
session already has.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on (UTC wall clock, AQE re-planning, skew
# splitting).  On a cluster these belong in the job submission; the helper
# below only applies them to a local test session.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Explicit broadcasts are only used for bounded inputs; everything else is
    # left to AQE, which converts a join to broadcast from runtime sizes.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera", extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.driver.memory", "16g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``.  Only when the session has
    none and runs in one process (local tests) is a private temporary folder
    created and registered; on a cluster that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if conf_dir:
        if not jdir.isDefined():
            # DataFrame.checkpoint() writes to the context's folder.
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if jdir.isDefined():
        return jdir.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return spark.conf.get("spark.checkpoint.dir").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_dir(path: str) -> None:
    if is_local_path(path):
        os.makedirs(path.replace("file:", ""), exist_ok=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster file system (no failed reads)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))
