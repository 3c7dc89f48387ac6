"""Spark session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name="landfall", master=None, shuffle_partitions=None, conf=None):
    """A session for the batch job.

    AQE turns small sides into broadcasts once their real size is known, splits
    skewed join partitions and merges small ones, so ``shuffle_partitions`` only
    has to be an upper bound (about input bytes / 128 MB on a cluster).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in spark.checkpoint.dir."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="landfall-")
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under this application's own folder in the shared one.

    Frames that are still to be read may stand on it, so nothing is removed while the application
    runs; the folder ``scratch-<application>`` of one that has ended can be deleted.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/scratch-{application}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def settle(df: DataFrame) -> DataFrame:
    """Compute a small derived table once and keep it in the shared folder.

    Later plans read the saved rows and survive lost executors. Catalyst keeps the size estimate
    of the original plan; where the true size matters, measure it.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
