"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "shedlake", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session. Clusters bring their own; nothing below needs this one."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{shared.rstrip('/')}/shedlake/{label}-{uuid.uuid4().hex[:12]}"
