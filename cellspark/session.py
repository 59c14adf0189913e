"""Spark session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers are for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def spark_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "cellspark") -> SparkSession:
    """A session tuned for the long-table workloads of this package.

    AQE is on so that shuffle partitions coalesce at run time and skewed
    join partitions are split; the UI is off (no server is started).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CELLSPARK_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads the SparkContext's directory, which ``spark.checkpoint.dir`` sets.  When
    neither is set, a local session (tests, one machine) gets a fresh folder under
    the system temporary directory; on a cluster executors could not share that,
    so RuntimeError is raised.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cellspark-ckpt-"))
    return sc.getCheckpointDir()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
