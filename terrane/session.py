"""Session settings that every query relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)

#: Set only where the session has no value of its own.
DEFAULTS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "2097152b"),
    "spark.sql.session.timeZone": (None, "UTC"),
}


def local_session(cores: int = 8, app: str = "terrane", shuffle: int | None = None) -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TERRANE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, and bound Arrow batches of long texts."""
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    for key, (default, value) in DEFAULTS.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all run in one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="terrane-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table written in the shared folder and read back, and its path.

    For loops that join a table with itself: a checkpoint keeps the plan's estimate of its size, the digits of which double with each such join.
    """
    path = f"{shared_folder(df.sparkSession)}/terrane-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join in which both sides grow with the input: neither is sent whole to the driver and all executors.

    The planner's estimate goes by the bytes of compressed files and does not see what explode adds, so it takes millions of rows for a small table.
    """
    return df.hint("merge")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored`` wrote."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
