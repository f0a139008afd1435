"""Session helpers: a tuned local/cluster session and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. They are safe to set on an existing
# session (no static configs here).
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "panelcast") -> SparkSession:
    """Session for tests, benchmarks and local jobs (UI off, AQE on)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.driver.memory", os.environ.get("PANELCAST_DRIVER_MEMORY", "8g")))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    On a cluster the setting must point at shared storage and is taken as is.
    Where it is unset, a fresh scratch folder is created for a session that runs in one
    local JVM (tests, a laptop); any other session is refused, as its executors would
    write to their own disks.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that functions running
    in Python workers import it wherever the job was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="panelcast-py-"), "panelcast.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Reliable checkpoints survive executor loss (unlike local checkpoints).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
