"""Session helpers: a tuned local session for tests/bench, and the shared
folder where staged tables, sinks and checkpoints go.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS/S3/ABFS...). Only when that setting is unset -- local tests and the
bench -- do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "scrubline") -> SparkSession:
    """A local session configured the way the library expects a cluster to be:
    AQE on (coalescing, skew-join), UTC session zone, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Coalesce small shuffles toward the advisory size (64 MB) rather than
        # keeping one partition per core: the production recommendation.
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SCRUBLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="scrubline-wh-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session; only if it is unset (tests, bench on one machine)
    is a fresh local folder created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get(_CKPT_KEY, None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that all executors share; "
                               "a folder of this machine would not do on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="scrubline-shared-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared folder. ``unique`` adds a random leaf so that
    repeated runs never collide (scratch folders are never cleared in place)."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([shared_root(spark), *leaf])
