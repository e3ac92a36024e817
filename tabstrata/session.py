"""Session helpers: building a local session for tests and locating the shared folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabstrata") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    On a cluster this is set by the operator and is visible to every executor.
    Only when it is unset (local tests) do we set one ourselves.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tabstrata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python may not have it; once a session.

    The archive is only made on the driver; Spark hands it to every worker.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_tabstrata_sent", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tabstrata-"), "tabstrata"), "zip", root, "tabstrata")
        sc.addPyFile(archive)
        sc._tabstrata_sent = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for an intermediate table or file."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
