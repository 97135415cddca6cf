"""Session helpers: a local session for tests and the bench, and the shared
folder that written tables go to.

Written tables (bronze, star, checkpoints) live under the folder the cluster
names in ``spark.checkpoint.dir``. It is read from the session; a local
temporary folder is set only when the session has none (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: SQL settings the results rest on; a session may have set them itself.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # an overflowing amount is an error, not a NULL that a filter then drops
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
SESSION_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"} | SQL_CONF


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "tripmart", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(SESSION_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session(app: str = "tripmart") -> SparkSession:
    """The submitted session: master and settings as submitted, with
    ``SQL_CONF`` where nothing else was given. Without a submitted master Spark
    itself falls back to this machine."""
    builder = SparkSession.builder.appName(app)
    if not {"PYSPARK_GATEWAY_PORT", "PYSPARK_SUBMIT_ARGS"} & set(os.environ):
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in SQL_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Only a local master may go
    without one: a folder of this machine is no folder of the executors."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
        path = tempfile.mkdtemp(prefix="tripmart-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one written table."""
    return f"{shared_dir(spark)}/tripmart/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(total_cores: int, shuffle_bytes: int | None = None,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run of the warehouse jobs.

    Shuffle partitions: at least 3 x cores (so every core has work after AQE
    coalescing) and enough that each holds about ``target_partition_bytes`` of
    the largest expected shuffle; AQE merges small ones and splits skewed
    ones. Scans keep 128 MB splits."""
    parts = 3 * total_cores
    if shuffle_bytes:
        parts = max(parts, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        **SQL_CONF,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    }
