"""Session settings, and the one place where a plan is cut."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# ANSI casts make a bad date or integer fail the build; UTC keeps dates equal on every executor.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # No call-site capture per column expression: building a plan takes half the round trips.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# A reduce task reads about this much of the largest shuffle; smaller shuffles are coalesced to it.
SHUFFLE_TASK_BYTES = 256 * 1024**2


def shuffle_settings(largest_shuffle_bytes: int) -> dict[str, str]:
    """Enough partitions for the largest shuffle to fit its tasks; the rest merge at run time."""
    partitions = max(200, -(-largest_shuffle_bytes // SHUFFLE_TASK_BYTES))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_TASK_BYTES),
    }


def build_session(
    app: str = "tallymart", master: str | None = None, largest_shuffle_bytes: int | None = None, **settings: str
) -> SparkSession:
    """Session with the settings above; keyword settings use ``__`` for dots and win over them.

    ``largest_shuffle_bytes`` is an estimate, for example of the contacts' key and flag columns.
    """
    chosen = SETTINGS | (shuffle_settings(largest_shuffle_bytes) if largest_shuffle_bytes else {})
    chosen |= {key.replace("__", "."): value for key, value in settings.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_folder(spark: SparkSession) -> str | None:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None and spark.sparkContext.master.startswith("local"):
        # Local runs only: on a cluster a folder of one machine would be lost with it.
        folder = tempfile.mkdtemp(prefix="tallymart-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write a reduced table that several branches read to the shared folder and read it back.

    The branches then scan that table instead of each repeating the scan and shuffle of the facts
    behind it, and a lost executor re-reads a file. Where the cluster names no shared folder the
    plan stays whole, with a warning: same result, more work.
    """
    folder = _shared_folder(df.sparkSession)
    if folder is None:
        warnings.warn("spark.checkpoint.dir names no folder: reduced tables are computed once a branch", stacklevel=2)
        return df
    path = f"{folder.rstrip('/')}/tallymart-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
