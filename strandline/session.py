"""Session and scratch-location helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stopGracefullyOnShutdown": "true",
}


def build_session(master: str = "local[8]", app: str = "strandline",
                  shuffle_partitions: int = 8, driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench. On a cluster the caller's own
    session is used and only ``work_root`` below is consulted."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``)."""
    try:
        master = spark.sparkContext.master
    except Exception:       # a remote session
        return False
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). When neither is set, a private folder is made and
    registered where driver and executors are one process (local master, as
    in tests); on a cluster that is an error, since a folder of one machine
    is not seen by the others.
    """
    try:
        sc = spark.sparkContext
    except Exception:       # a remote session has no context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="strandline-chk-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", d)
    if sc is None:
        return d.rstrip("/")
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def work_root(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint folder for one
    run's tables, landing drops and stream checkpoints."""
    return f"{checkpoint_dir(spark)}/strandline/{label}-{uuid.uuid4().hex[:12]}"
