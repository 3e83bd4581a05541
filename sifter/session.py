"""Session helpers for tests, bench and command-line runs.

Library operators never create a session; they take DataFrames. These helpers
only fill in settings that are unset, so a cluster's own configuration wins.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "sifter") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("SIFTER_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    Uses ``spark.checkpoint.dir`` (or a directory already set on the context).
    Only when nothing is set and the master is local (tests) is a scratch
    folder created: on a cluster each executor would write to a disk of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no context, use the conf only
        sc = None
    current = sc.getCheckpointDir() if sc is not None and hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if fallback is None and not (sc is not None and sc.master.split("[")[0] == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = fallback or tempfile.mkdtemp(prefix="sifter-ckpt-", dir="/tmp")
        if sc is None:
            try:
                spark.conf.set("spark.checkpoint.dir", conf)
            except Exception:  # noqa: BLE001 - static conf on some sessions
                pass
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return conf


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and stream checkpoints."""
    return ensure_checkpoint_dir(spark)
