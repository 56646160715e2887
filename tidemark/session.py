"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "tidemark", cpus: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    cores = cpus or os.cpu_count() or 8
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine:
    on a cluster no other executor could read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
