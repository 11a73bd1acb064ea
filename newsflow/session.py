"""Session helpers.

Library code never creates a ``SparkSession`` and never sets ``master``; the
submitter does. ``build_session`` exists for tests, the bench and the CLI entry.
``shared_path`` gives a place for intermediate tables and checkpoints: it lives
under ``spark.checkpoint.dir`` (a shared folder on a cluster). Only a local
master without that setting gets a temporary one.
"""

from __future__ import annotations

import atexit
import logging
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)
CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", app_name: str = "newsflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (UTC, AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def get_session(app_name: str = "newsflow") -> SparkSession:
    """JOB-7 for submitted jobs: no master (the submitter sets it), UTC, AQE; shuffle width left to AQE."""
    spark = (SparkSession.builder.appName(app_name)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .getOrCreate())
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting is required: a folder of one machine would be
    missing on the others. Only a local master without it gets a temporary one.
    """
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all machines share (master: {master})")
        path = tempfile.mkdtemp(prefix="newsflow-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return jsc.getCheckpointDir().get()


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder; ``unique`` adds a run id.

    Intermediates live below the folder of the application and go with it when
    the driver's Python ends; ``unique=False`` names a lasting place instead.
    """
    root = os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "newsflow")
    if not unique:
        return os.path.join(root, *parts)
    mine = os.path.join(root, spark.sparkContext.applicationId)
    if mine not in _OWN:
        _OWN.add(mine)
        atexit.register(_delete, spark, mine)
    return os.path.join(mine, *parts, uuid.uuid4().hex[:12])


_OWN: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    """Remove the application's intermediates; a session that is gone already leaves them."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the JVM ended first
        log.debug("intermediates not removed: %s", path)
