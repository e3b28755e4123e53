"""Session defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", memory: str = "16g", app: str = "newsflow") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    parallel = "8" if cpus == "*" else str(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", parallel)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only when that is
    unset in a local session (tests) a temporary folder of this machine is used;
    on a cluster that would lose data, so it is refused.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        parent = tempfile.mkdtemp(prefix="newsflow-")
    return f"{parent.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
