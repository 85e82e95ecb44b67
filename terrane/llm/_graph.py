"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import discard, released, tidy, written
from terrane.session import shuffled

#: Edges that one task joins by itself, some 2 MB there: a round of stars costs eight stages of tasks, however few the edges are.
AT_ONCE = 1 << 14


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, comp) of the edges of one task."""
    up: dict = {}

    def top(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(y, y)
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    if up:
        nodes = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(x, batch.column(0).type) for x in (nodes, [top(x) for x in nodes])], ["node", "comp"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, comp): the smallest node that the undirected edges (a, b) reach, for every node they name.

    Each step hands a node's neighbours to the smallest of them; both aggregate before they
    shuffle and emit at most one row for each edge, so no task holds the neighbours of a node.
    The edges are a forest of stars when a round changes nothing; a null end drops the edge.
    Edges that are no more than AT_ONCE, repeated ones counted, take no rounds.
    """
    now, path = written(edges.select("a", "b").where("a is not null and b is not null and a <> b"), "edges")
    if now.count() <= AT_ONCE:
        kind = now.schema["a"].dataType.simpleString()
        out = now.coalesce(1).mapInArrow(tidy(_joined), f"node {kind}, comp {kind}")
    else:
        now, path = _stars(now, path, most_rounds)
        out = now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
    found = written(out, "comps")[0]  # it is read more than once
    discard(now.sparkSession, path)
    return found


def _stars(now: DataFrame, path: str, most_rounds: int) -> tuple[DataFrame, str]:
    """The edges as a forest of stars, written, and its folder; that of the edges goes."""
    last = None
    for _ in range(most_rounds):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(shuffled(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))  # larger ends to the least
        large = large.where("a <> b")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(shuffled(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        (now, path), before = written(small.where("a <> b").distinct(), "edges"), path
        discard(now.sparkSession, before)
        released(now.sparkSession)  # a round has many small plans, and the driver's heap grows before it is cleared
        mark = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark == last:
            return now, path
        last = mark
    raise RuntimeError("the components did not settle")
