"""Sharding by a hierarchical weighted hash tree.

Every node of the tree (region, rack, shard) has a weight. A row descends the three levels; at
each it draws a number for every child, ``-ln(u) / weight`` with u from a hash of the row's key
and the child's name, and takes the least. A child's draw depends on its own weight alone, so a
change of weights moves rows only into or out of the subtrees whose weights changed.

DataFrame functions only: the tree is a bounded list of literals inside the plan, placement is a
projection without shuffle, and slots take a checkpoint and one shuffle of narrow rows.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm._common import OWN, cut


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(n_shards: int, base: int = 40, region_size: int = 8, rack_size: int = 2) -> list[Leaf]:
    """The tree for a count of shards.

    The first ``base`` shards fill regions of ``region_size`` shards in racks of ``rack_size``.
    Every later shard opens a region of its own: it is the only subtree whose weight changes, so
    growing by one shard moves rows into the new shard and nowhere else. That holds from ``base``
    shards up, so fewer are refused; give the base that the shards were first laid out with.
    """
    if n_shards < max(1, base):
        raise ValueError("n_shards must be positive and at least base: below it, growth would move rows between old shards")
    if base % region_size or region_size % rack_size:
        raise ValueError("base must fill its regions, and a region its racks")
    first = [Leaf(s // region_size, s // rack_size, s) for s in range(base)]
    return first + [Leaf(base // region_size + i, base // rack_size + i, base + i) for i in range(n_shards - base)]


def _family(tree: dict[int, dict[int, float]]) -> Column:
    """A literal map from a node to its children, each with its weight."""
    entries = []
    for parent, children in sorted(tree.items()):
        kids = [F.struct(F.lit(n).alias("n"), F.lit(float(w)).alias("w")) for n, w in sorted(children.items())]
        entries += [F.lit(parent), F.array(*kids)]
    return F.create_map(*entries)


def _choose(key: Column, level: str, children: Column) -> Column:
    """The child with the least -ln(u) / weight, u in (0, 1) from 53 bits of xxHash64 over key, then name."""

    def drawn(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.concat(F.lit(f"{level}:"), child["n"].cast("string"))), 11)
        u = (bits.cast("double") + 0.5) / F.lit(float(2**53))
        return F.struct((-F.log(u) / child["w"]).alias("d"), child["n"].alias("n"))

    return F.array_min(F.transform(children, drawn))["n"]


def place(df: DataFrame, key: Column, tree: list[Leaf], out: str) -> DataFrame:
    """Add column ``out``: the shard that the tree gives to each row. Rows with a null key share one place."""
    tree = [x for x in tree if x.weight > 0]
    if not tree or len({x.shard for x in tree}) != len(tree):
        raise ValueError("the tree needs shards with weight, each of them once")
    regions: dict[int, float] = defaultdict(float)
    racks: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    shards: dict[int, dict[int, float]] = defaultdict(dict)
    for x in tree:
        regions[x.region] += x.weight
        racks[x.region][x.rack] += x.weight
        shards[x.rack][x.shard] = x.weight
    k, region, rack = f"{OWN}key", f"{OWN}region", f"{OWN}rack"
    name = F.concat(F.lit("k:"), F.coalesce(key.cast("string"), F.lit("\0")))
    df = df.withColumn(k, name).withColumn(region, _choose(F.col(k), "region", _family({0: regions})[F.lit(0)]))
    df = df.withColumn(rack, _choose(F.col(k), "rack", _family(racks)[F.col(region)]))
    df = df.withColumn(out, _choose(F.col(k), "shard", _family(shards)[F.col(rack)]))
    return df.drop(k, region, rack)


def number_slots(df: DataFrame, shard: str, order: list[str], out: str, buckets: int = 256) -> DataFrame:
    """Add column ``out``: gapless numbers from 0 within each shard.

    Rows are numbered inside (shard, bucket); the counts of the buckets, at most shards x
    ``buckets`` rows and so safe to broadcast, give each bucket its offset. A row's bucket is drawn
    by its place in the checkpoint, not its content, so no task holds a shard or all equal rows.
    """
    bucket, n, base, inner = (f"{OWN}{x}" for x in ("bucket", "n", "base", "inner"))
    rows = cut(df.withColumn(bucket, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)).cast("int")))
    sizes = rows.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(shard, bucket, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    within = Window.partitionBy(shard, bucket).orderBy(*order)
    rows = rows.withColumn(inner, F.row_number().over(within) - 1)
    joined = rows.join(F.broadcast(bases), [shard, bucket])
    return joined.select(*df.columns, (F.col(base) + F.col(inner)).alias(out))


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tree: list[Leaf] | None = None, grown: list[Leaf] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``law`` is ``key``: id and tree alone decide. ``grown_shard`` is the place after ``grown``,
    by default one more shard. A null text counts as empty (size 16), rows with a null id share a
    shard, equal rows get slots in any order, an empty table gives no rows; other columns of
    ``docs`` are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(rows, F.col("doc_id"), tree or topology(n_shards), "shard")
    rows = place(rows, F.col("doc_id"), grown or topology(n_shards + 1), "grown_shard")
    rows = number_slots(rows, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
