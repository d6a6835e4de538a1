"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Static and runtime settings for a session that this package creates itself. On a
# cluster, shuffle partitions start high and AQE coalesces or splits them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "shelfdiff", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Runs are compared as instants; text forms of them assume UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, `spark.checkpoint.dir`.

    Only where neither the session nor the context names one and the master is local
    (tests, a laptop) a local folder is made and set as the checkpoint folder. On a
    cluster its executors could not see that folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfdiff-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """`df` written once below the shared folder and read back: for results that several
    jobs or several branches of one job read. Survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that they can
    import it wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="shelfdiff-ship-")
    root, name = os.path.split(package)
    archive = shutil.make_archive(os.path.join(folder, name), "zip", root, name)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
