"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Codec of stored layers: half the bytes of the default one for lines and documents.
COMPRESSION = "zstd"


def build_session(app: str = "meterproof", **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """All instants are UTC; a session built elsewhere may have another zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or the context's checkpoint folder.

    There is no machine-local fallback: on a cluster each executor would write to a disk of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("no shared folder: set spark.checkpoint.dir or call SparkContext.setCheckpointDir")
    return configured.rstrip("/")


def use_local_dir(spark: SparkSession) -> None:
    """For tests and benches in one JVM: a temporary folder, unless a shared one is configured."""
    local = spark.sparkContext.master.split("[")[0] == "local"
    if local and not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meterproof-"))
