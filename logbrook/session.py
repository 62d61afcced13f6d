"""Session helpers: a local session for tests, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session for tests and timing; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("logbrook")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder every executor can reach, for checkpoints and written logs.

    It lies under ``spark.checkpoint.dir``. Only a local-mode session may go
    without that setting; it then gets a folder on its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = os.path.join(tempfile.gettempdir(), "logbrook")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
