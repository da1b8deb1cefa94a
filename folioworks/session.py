"""Session settings the jobs rely on, and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only, so they can be applied to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split hot key is worth an extra exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime settings that nobody has set yet and return the session; a caller's own choice stays."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "folioworks", cpus: str | None = None) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        # On little data even small partitions are worth a core each, since parsing costs far more than reading.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a local session without one gets a temporary folder, once."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        # Only where driver and executors are one process; local-cluster is a cluster.
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="folioworks-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession) -> str:
    """A new folder for the intermediate tables of one run, inside the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4()}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a work folder and all in it, wherever it is stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder, so that a lost executor costs no replay of what led to it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
