"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "colonnade", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes (UTC, adaptive plans)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    may fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = os.environ.get("COLONNADE_LOCAL_SCRATCH")
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="colonnade-")
            os.environ["COLONNADE_LOCAL_SCRATCH"] = root
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_root(spark)}/colonnade/{uuid.uuid4().hex}/{name}"


_SIZED: set[tuple[str, str]] = set()


def size_shuffles(spark: SparkSession, tables) -> None:
    """Start shuffles with enough partitions for the input, once per session and folder.

    A fixed number suits one size only: 200 partitions of a 100 TB table hold 500 GB each.
    Two shuffle partitions per input split of the largest table keep every one near the
    split size; adaptive execution merges them where a shuffle turns out small. Nothing
    changes while the configured number is already enough.
    """
    key = (spark.sparkContext.applicationId, tables.path)
    if key in _SIZED:
        return
    _SIZED.add(key)
    needed = 2 * max(getattr(tables, name).rdd.getNumPartitions() for name in ("lineitem", "documents", "events"))
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if needed > current:
        spark.conf.set(initial, str(needed))
