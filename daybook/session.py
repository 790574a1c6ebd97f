"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # wide tables make long methods; beyond this size the JVM would interpret them
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "daybook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def compiled(spark: SparkSession) -> None:
    """Sets the limit of generated methods in a session that was made elsewhere.

    Spark's own limit lets methods pass that the JVM never compiles but interprets.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(limit, SETTINGS[limit])


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, visible to every executor.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local session
    may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
