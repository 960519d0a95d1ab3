"""Session helpers: a local session for tests and the bench, and the shared
scratch location (always under the cluster's checkpoint directory)."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "souk") -> SparkSession:
    """A ``local[N]`` session for tests and benchmarks (never used by the library)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # HotSpot does not JIT methods above 8000 bytes of bytecode; past that
        # a fused stage is better run by Spark's own expression evaluators
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SOUK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory; set a private one only when unset in
    local mode (tests). A cluster without one is a configuration error."""
    d = checkpoint_dir(spark)
    if d:
        return d
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[0-9*]+(,\s*\d+)?\])?", master):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    d = tempfile.mkdtemp(prefix="souk-ckpt-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def staging_session(spark: SparkSession) -> SparkSession:
    """A session of its own for one pass that deals rows into two folders: it
    keeps a file open for each, so no task holds and sorts its rows first (a
    part of a file of short lines is many rows)."""
    own = spark.newSession()
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/souk-scratch/{name}-{uuid.uuid4().hex}"
