"""Session helpers: the shared work folder and scoped configuration changes."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def work_root(spark: SparkSession) -> str:
    """Shared folder for stages, backups, audits and scratch tables.

    On a cluster this is the folder the session names in ``spark.checkpoint.dir``
    (a shared file system such as HDFS or an object store). Only when the session
    names none -- as in local tests -- a fresh temporary folder is created and
    registered as the checkpoint folder, so that later calls agree on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
        if root:
            # getCheckpointDir() adds a per-application sub-folder; use its parent.
            root = root.rstrip("/").rsplit("/", 1)[0]
    if not root:
        root = tempfile.mkdtemp(prefix="keysweep-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_run_id(spark: SparkSession) -> str:
    """Run identity: the application id plus a short random suffix, so that
    several purges in one application never share a folder."""
    app = spark.sparkContext.applicationId or "app"
    return f"{app}-{uuid.uuid4().hex[:8]}"


@contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Set SQL configuration values for the duration of a block, then restore them.

    Use as ``with session_conf(spark, **{"spark.sql.x": "v"}): ...``.
    """
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def child_session(spark: SparkSession) -> SparkSession:
    """A session sharing the caller's SparkContext and catalog, with a copy of
    its runtime SQL settings but its own configuration and temporary views --
    so a purge running in a thread can change session settings (the dynamic
    partition-overwrite mode) without touching the caller or other threads."""
    child = spark.newSession()
    for k, v in spark.conf.getAll.items():
        try:
            child.conf.set(k, v)
        except Exception:  # static or read-only settings are already shared through the context
            pass
    # unqualified names must mean the same tables as in the caller's session
    child.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    child.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return child


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "keysweep") -> SparkSession:
    """Session used by tests and the local benchmark (no UI, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KEYSWEEP_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
