"""Session helpers: local session for tests/bench and the shared work folder.

On a cluster the caller owns the SparkSession; nothing here overrides the
cluster's settings.  ``shared_dir`` resolves scratch locations under the
folder the cluster names in ``spark.checkpoint.dir``; only when that is
unset (local tests) does it create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "casaframe") -> SparkSession:
    """A local[N] session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("CASAFRAME_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Taken from the running context or from ``spark.checkpoint.dir``; a
    private temporary folder is created only when neither is set and the
    master is local (tests).  On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to the other executors
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        configured = tempfile.mkdtemp(prefix="casaframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the checkpoint folder for written tables and stream state."""
    root = checkpoint_root(spark).rstrip("/")
    segs = list(parts)
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join([root, "casaframe", *segs])


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and cut lineage.

    Used where two branches of a plan must see exactly the same rows and
    partition ids, and where a lost executor must not force a recompute
    with a different partition assignment.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
