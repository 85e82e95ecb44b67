"""Replication by sequence: change files arrive, a store follows, nothing is dropped for being late."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.entities import latest
from terrane.streaming.store import Store


def read_changes(spark: SparkSession, path: str, schema: str, most_files: int | None = None) -> DataFrame:
    """A stream of Parquet change files; the checkpoint is the replication state."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", most_files) if most_files else reader).parquet(path)


def interval(changes: DataFrame, begin, end, ts: str = "ts") -> DataFrame:
    """Changes in (begin, end]."""
    return changes.where((F.col(ts) > F.lit(begin)) & (F.col(ts) <= F.lit(end)))


def lag_seconds(changes: DataFrame, now, ts: str = "ts") -> DataFrame:
    """How far behind ``now`` the latest change is."""
    return changes.agg((F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.max(F.col(ts).cast("timestamp")))).alias("lag_us"))


def merge_intervals(changes: DataFrame, width: str, keys: tuple = ("id",), ts: str = "ts") -> DataFrame:
    """Small deltas collapsed into aligned intervals: the last change of each entity in each."""
    start = F.window(F.col(ts).cast("timestamp"), width)["start"]
    placed = changes.withColumn("interval_start", start)
    return latest(placed, ["interval_start", *keys], [F.desc("version"), F.desc(ts)])


def follow(changes: DataFrame, store: Store, checkpoint: str, hook: Callable[[DataFrame], None] | None = None):
    """Apply the stream to the store, batch by batch, until all that is there now has been read."""
    query = changes.writeStream.foreachBatch(lambda df, n: store.apply(df, n, hook=hook)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return store.read()
