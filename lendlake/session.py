"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "lendlake") -> SparkSession:
    """Session for tests and benches; on a cluster the submitter's settings apply."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # The JVM never compiles methods over 8000 bytes; wide projections that would exceed
        # that in one generated stage run several times faster without fusing the stage.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session may fall back to a folder of its own: on a cluster a machine-local
    folder would be lost with its executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lendlake-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for an intermediate table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/lendlake/{name}-{uuid.uuid4().hex}"
