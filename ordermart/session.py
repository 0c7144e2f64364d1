"""Session construction for tests and the benchmark.

Library code never builds a session; it receives one. On a cluster the
session comes from the platform and already names ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def _private_folder(prefix: str) -> str:
    """A folder for one local run, removed when the process ends."""
    path = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the session names.

    Only when the setting is absent and Spark runs in local mode (tests) is
    a private folder created and registered; on a cluster a missing setting
    is an error, never a machine-local temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(scratch tables and lineage cuts are written there)")
        configured = _private_folder("ordermart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "ordermart") -> SparkSession:
    """A local session tuned like the cluster profile: AQE with partition
    coalescing, skew-join splitting and runtime (measured) broadcast
    decisions, no estimate-based static broadcast, UI off, UTC clock."""
    cores = int(cores) if str(cores) != "*" else os.cpu_count() or 8
    parts = shuffle_partitions or max(8, int(cores))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no broadcast from estimates of joined or aggregated inputs; AQE
        # converts joins from measured shuffle sizes, and the library hints
        # broadcast only where the files below a dimension are small
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ORDERMART_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", os.environ.get("ORDERMART_WAREHOUSE",
                                                          _private_folder("ordermart-warehouse-")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
