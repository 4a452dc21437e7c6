"""Session settings the operators are written for, and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions, splits skewed join sides and turns a
# shuffle join into a broadcast one when a side proves small at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Local fallback folders by application.
_fallback: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session it gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    # local, local[4], local[*]; not local-cluster[...], whose executors are processes of their own.
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _fallback:
        _fallback[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _fallback[application]


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
