"""Replication from a database by transaction ids: which delta a change belongs to, by snapshots of what was visible.

A snapshot is (sequence, xmax, active): ids from xmax on had not begun, ids in active had begun and not ended. A
change is visible to a snapshot if its id is below xmax and not active. Ids are given at the begin of a transaction,
so that one that ends late has a smaller id than others that were sent long before: a time or id reached would lose it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.session import shuffled

SNAPSHOT = "sequence long, xmax long, active array<long>"
#: Ids in a block of the join between changes and the ranges of ids of snapshots.
BLOCK = 4096


def first_seen(changes: DataFrame, snapshots: DataFrame, txid: str, before=None) -> DataFrame:
    """``changes`` with ``sequence``: the first snapshot that sees each; those that none sees, or ``before`` saw, go.

    Sequences ascend with xmax, and an id stays active until it ends. ``before`` is the snapshot sent last. Changes with
    a null id go; repeated ones stay repeated. Ranges of ids and ids in flight are joined by equality, so no snapshot meets all changes.
    """
    first = before["xmax"] if before else 0
    order = Window.orderBy("sequence")  # over snapshots: one row a delta
    named = snapshots.select("sequence", "xmax", F.coalesce("active", F.array().cast("array<long>")).alias("active"))
    ranges = named.select("sequence", F.coalesce(F.lag("xmax").over(order), F.lit(first)).alias("low"), F.col("xmax").alias("high"), F.lead("sequence").over(order).alias("following"))
    held = named.select(F.explode("active").alias("id"), "sequence").groupBy("id").agg(F.max("sequence").alias("held"))
    later = ranges.select(F.col("sequence").alias("held"), "following")
    held = held.join(later, "held").select(F.col("id").alias("__id"), F.col("following").alias("__late"), F.lit(True).alias("__held"))
    block = lambda c: F.floor(c / BLOCK)
    blocks = ranges.where("low < high").select(F.col("sequence").alias("__first"), F.col("low").alias("__low"), F.col("high").alias("__high"), F.explode(F.sequence(block(F.col("low")), block(F.col("high") - 1))).alias("__block"))
    mine = changes
    if before:  # reaches the scan: nothing below the oldest id in flight is read
        open_ids = sorted(before["active"] or [])
        mine = mine.where(F.col(txid) >= min([first, *open_ids])).where((F.col(txid) >= first) | F.col(txid).isin(open_ids))
    rows = mine.drop("sequence").withColumn("__id", F.col(txid).cast("long")).where("__id is not null").withColumn("__block", block(F.col("__id")))
    new = rows.join(blocks, (rows["__block"] == blocks["__block"]) & (rows["__id"] >= blocks["__low"]) & (rows["__id"] < blocks["__high"])).drop(blocks["__block"])
    if before:  # ids that were in flight then have ended by the first snapshot, or are active in it
        start = snapshots.agg(F.min("sequence").alias("__first"))
        new = new.select(*rows.columns, "__first").unionByName(rows.where(F.col("__id") < first).join(F.broadcast(start)).select(*rows.columns, "__first"))  # one row
    placed = new.join(held, "__id", "left").withColumn("sequence", F.when(F.col("__held"), F.col("__late")).otherwise(F.col("__first")))
    return placed.where("sequence is not null").select(*[F.col(f"`{c}`") for c in changes.columns if c != "sequence"], "sequence")


def replicate(spark: SparkSession, changes: DataFrame, snapshots: str, out: str, checkpoint: str, txid: str, most_files: int | None = None) -> DataFrame:
    """Follow a folder of snapshots as a stream and write each delta to ``out``/sequence=N, once.

    A batch takes what its snapshots see and the last one before them did not. That one is looked up by sequence, so a batch that is
    run again after a failure writes the same deltas over itself. A delta without changes has no folder.
    """

    def batch(df: DataFrame, _: int) -> None:
        lowest = df.agg(F.min("sequence")).first()[0]
        if lowest is None:
            return
        seen = df.sparkSession.read.schema(SNAPSHOT).parquet(snapshots).where(F.col("sequence") < lowest)
        before = seen.orderBy(F.desc("sequence")).first()
        found = first_seen(changes, df, txid, before)
        found.hint("rebalance", "sequence").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sequence").parquet(out)

    shape = changes.drop("sequence").withColumn("sequence", F.lit(0).cast("long"))
    shape.where(F.lit(False)).write.mode("append").partitionBy("sequence").parquet(out)  # the folder is there even if no delta is
    reader = spark.readStream.schema(SNAPSHOT)
    reader = reader.option("maxFilesPerTrigger", most_files) if most_files else reader
    query = reader.parquet(snapshots).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(shape.schema).parquet(out)


def snapshots_of(transactions: DataFrame, txid: str, began: str, ended: str) -> DataFrame:
    """SNAPSHOT rows of whole numbered moments, from when each transaction began and ended (null: still open at the last moment).

    Moment k sees what ended at k or before. For tests and logs that hold both moments; a database gives its own snapshots.
    """
    bounds = transactions.agg(F.min(began).alias("a"), F.greatest(F.max(began), F.max(ended)).alias("b"))
    moments = bounds.select(F.explode(F.sequence("a", "b")).alias("sequence"))
    until = F.coalesce(F.col(ended) - 1, F.col("b"))
    open_at = transactions.join(F.broadcast(bounds)).where(F.col(began) <= until)  # one row
    active = open_at.select(F.explode(F.sequence(F.col(began), until)).alias("sequence"), txid).groupBy("sequence").agg(F.array_sort(F.collect_set(txid)).alias("active"))
    highest = transactions.groupBy(F.col(began).alias("sequence")).agg((F.max(txid) + 1).alias("xmax"))
    # The running maximum is one task's, over a row a moment; the ids in flight, which grow with the input, are joined after it.
    reached = moments.join(highest, "sequence", "left").select("sequence", F.max("xmax").over(Window.orderBy("sequence")).alias("xmax"))
    return reached.join(shuffled(active), "sequence", "left").select("sequence", "xmax", F.coalesce("active", F.array().cast("array<long>")).alias("active"))
