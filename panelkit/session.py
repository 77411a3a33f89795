"""Session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers exist for tests, the benchmark and ad-hoc runs on one machine.  On a
cluster the session comes from the platform and only the SQL settings that
change semantics (UTC time zone, AQE) matter.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on for identical results on every engine.
SEMANTIC_CONF = {
    # Dates and timestamps are compared with a UTC oracle.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only shape the physical plan.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hot participants / waves: let AQE split skewed partitions of joins.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Split a hot join key even when the split costs an extra shuffle: the
    # aggregate after the join then combines the hot key map-side.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method above 8,000 bytes of bytecode.  The
    # harmonisers' projections make larger ones; beyond this limit Spark plans
    # them without whole-stage code, as many small methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "panelkit") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PANELKIT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call-site capture for error messages walks the Python stack
        # on every Column call (~2 ms each); plans built from hundreds of
        # generated expressions spend seconds in it on the driver.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in {**SEMANTIC_CONF, **PLAN_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is always
    respected.  Only a local session without one (tests) gets a fresh scratch
    folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    # Only local sessions (tests) get here: driver and executors are one process.
    path = tempfile.mkdtemp(prefix="panelkit-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the session's shared checkpoint folder.

    Used where a job writes an intermediate table (snapshots, round trips);
    never a machine-local temp folder on a cluster.
    """
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """``settings`` of the session for the block's actions; afterwards what was set before."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
