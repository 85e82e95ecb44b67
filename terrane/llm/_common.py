"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.session import shared_folder

#: Prefix of internal columns, so that no column of the caller clashes.
OWN = "__terrane_"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    return shared_folder(spark)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder in the shared one that nothing has been written to."""
    path = f"{shared_dir(spark)}/terrane-{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and cut its lineage; Spark drops the files with the DataFrame."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as zstd Parquet into the shared folder and read it back: smaller than a checkpoint.

    Its size is known to Spark. That of a checkpoint is guessed from the plan before, which in a loop of joins
    grows beyond all bounds, so loops use this.
    """
    return written(df, name)[0]


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored``, with the folder, for what is to be discarded."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


#: Folders that the innermost ``spare`` will discard.
_OPEN: list[list[str]] = []


@contextmanager
def spare(spark: SparkSession):
    """Discard at the end what ``stored`` has written inside; whatever reads it must have been written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            discard(spark, path)


def released(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that no DataFrame refers to any more: it does so when the driver collects garbage.

    The driver's Python gives back what it has freed, too.
    """
    trim()
    spark._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trim() -> None:
    """Give this process's freed memory back."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # the C library's, where it has one


def tidy(run):
    """A task's function that gives its memory back when it ends: Python workers live on from stage to stage."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def as_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string or binary column as bytes objects, without decoding."""
    column = batch.column(batch.schema.get_field_index(name))
    return (column if pa.types.is_binary(column.type) else column.cast(pa.binary())).to_pylist()


def text_of(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))
