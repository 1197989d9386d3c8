"""Session helpers: the SQL settings the operators rely on.

Nothing here changes results; the operators use ``timestamp_ntz`` and keep keys
in their stored type, so they give the same rows under any session time zone and
with ANSI mode on or off (text that is no amount or timestamp is an error with ANSI
on and NULL without). These settings only shape the physical plan.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings that shape the plans of the operators.
TUNING = {
    # Adaptive execution: coalesce small shuffle partitions, turn sort-merge
    # joins into broadcast joins when a side is measured small at run time,
    # and split skewed partitions (one order, seller or person holding a
    # large share of the rows).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Apply the skew split even when the aggregate above the join then needs
    # its own (partial-aggregated, hence small) shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Set only where the session says nothing. A task of the large join sorts both
# sides and holds an aggregate of its rows, 20 to 30 times the bytes it reads from
# the (compressed) shuffle. Rows are dealt over many partitions, which adaptive
# execution puts together up to the size below: a task's memory depends on that size and
# not on the input, until the partitions themselves are larger (about 16 GB in one shuffle).
TASK_SIZE = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`TUNING`, and :data:`TASK_SIZE` where it is not set, to a running session (idempotent)."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    for key, value in TASK_SIZE.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if none is set.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system). Only a local-mode session without the setting, as in tests,
    gets a fresh folder under the machine's temporary directory.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="mercato-ckpt-"))
    return sc.getCheckpointDir()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "mercato") -> SparkSession:
    """A local-mode session for tests and the bench (UI off, UTC, tuned)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # whole filters in plan texts, whatever the length of the columns' numbers in them
        .config("spark.sql.maxMetadataStringLength", "2000")
        # a checkpoint's files go when nothing refers to it any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("MERCATO_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    ensure_checkpoint_dir(spark)
    return spark
