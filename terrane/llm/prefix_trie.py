"""The trie of all prefixes of conversations, as the Cartesian tree of their sorted LCP array.

Conversations are rows of turn digests, range-partitioned and sorted; a partition is a block. Two
neighbours share their longest common prefix (LCP). A row opens one node for each depth beyond the
LCP with its predecessor, and such a node reaches to the next row with a smaller LCP. So nodes in row
order are in preorder, a subtree is a range of nodes, and its sums are differences of running totals.

* Within a block nearest smaller values give the Cartesian tree: equal LCP values between the same
  smaller ones are one node, and the depths between it and its parent are nodes with the same rows.
* Nodes that go on beyond a block are found by the blocks' minima: the one of depth d that enters a block was
  opened in the nearest block before with a minimum under d. Each block adds its part of every such
  node, first the numbers of rows and children, then, when these are known, sums over subtrees.

A block is one row of arrays, so each pass is one task a block, whatever the number of copies of
a conversation or of its first turns. On the driver are two numbers for each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import discard, stored, text_of, tidy, written
from terrane.llm._rmq import RangeMin, next_smaller, previous_smaller

#: Turns of a block, about.
BLOCK_TURNS = 1 << 14
DIGEST = 16
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turns: every conversation's turns in order as structs of turn, digest (hex) and words.

    Rows of one turn number are in order of their digest. Texts go no further than here.
    """
    role = text_of("role")
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text_of("text")).cast("binary"))
    words = F.regexp_count(text_of("text"), F.lit(WORD)).cast("long")
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", digest.alias("digest"), words.alias("words")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _lcp(a: bytes, b: bytes) -> int:
    """Digests that two keys begin with alike."""
    n = min(len(a), len(b))
    unlike = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(unlike.argmax()) if unlike.any() else n) // DIGEST


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition as one row: LCPs with the row before, lengths, ids, and words of the nodes that rows open."""
    convs, lengths, lcps, words, first, last = [], [], [], [], None, None
    for batch in batches:
        keys = batch.column(1).to_pylist()
        convs.append(batch.column(0).to_numpy())
        for key, own in zip(keys, batch.column(2), strict=True):
            shared = 0 if last is None else _lcp(last, key)
            first, last = key if first is None else first, key
            lcps.append(shared)
            lengths.append(len(key) // DIGEST)
            words.append(own.values.to_numpy(zero_copy_only=False)[shared:])
    if first is not None:
        arrays = (np.concatenate(convs), np.array(lcps, np.int64), np.array(lengths, np.int64), np.concatenate(words).astype(np.int64))
        least = min(lcps[1:], default=None)
        row = [[TaskContext.get().partitionId()], [first], [last], [least], *[[x.tobytes()] for x in arrays]]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], BLOCK_COLUMNS)


BLOCK_COLUMNS = ["block", "first", "last", "least", "convs", "lcps", "lengths", "words"]


def _border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [_lcp(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64())], ["block", "least", "lcp"])


@dataclass
class Borders:
    """For each block in order: the LCP that its first row has with the row before, and the least LCP of its rows. The root counts as depth 1."""

    lcp: np.ndarray
    least: np.ndarray

    def __post_init__(self):
        self.before = previous_smaller(self.least)

    def owners(self, k: int) -> np.ndarray:
        """For depths 1 to the LCP at the start of block k, the block that opened the node entering it."""
        chain, j = [], k - 1
        depths = np.arange(1, self.lcp[k] + 1)
        while j >= 0:
            chain.append(j)
            if self.least[j] < 1:
                break
            j = int(self.before[j])
        at = len(chain) - np.searchsorted(self.least[chain[::-1]], depths, "left")  # chain members that are not under d
        return np.array(chain, np.int64)[at] if len(depths) else depths

    def after(self, k: int) -> int:
        return int(self.lcp[k + 1]) if k + 1 < len(self.lcp) else 0


class Block:
    """The nodes that a block's rows open, in preorder, and what of entering nodes is in the block."""

    def __init__(self, row: dict, borders: Borders):
        k = self.k = row["k"]
        self.convs, lcps, lengths, words = (np.frombuffer(row[c], np.int64) for c in ("convs", "lcps", "lengths", "words"))
        n = self.n = len(self.convs)
        lcp = self.lcp = lcps + 1
        lcp[0] = borders.lcp[k]
        length, opened = lengths + 1, lengths + 1 - lcp
        self.opened, self.length, self.after = opened, length, borders.after(k)
        self.start = np.concatenate([[0], np.cumsum(opened)])
        self.row = np.repeat(np.arange(n), opened)
        self.depth = np.arange(self.start[-1]) - self.start[self.row] + lcp[self.row] + 1
        stored_from = np.concatenate([[0], np.cumsum(lengths - lcps)])  # words of each row beyond its LCP; the root has none
        self.words = np.where(self.depth == 1, 0, words[np.minimum(stored_from[self.row] + self.depth - 2 - lcps[self.row], len(words) - 1)] if len(words) else 0)
        smaller, nearest = previous_smaller(lcp), next_smaller(lcp)
        # Cartesian nodes, equal values merged: rows from `smaller` to `nearest`, for the depths above the next lower one of the same opener.
        inner = np.flatnonzero(smaller >= 0)
        opener, value, ends = smaller[inner], lcp[inner], nearest[inner]
        _, one = np.unique(opener * (int(lcp.max(initial=0)) + 1) + value, return_index=True)
        opener, value, ends = opener[one], value[one], ends[one]
        lower = np.where(np.concatenate([[-1], opener[:-1]]) == opener, np.concatenate([[0], value[:-1]]), lcp[opener])
        self.end = self.row + 1
        spans = value - lower
        at = np.repeat(self.start[opener] + lower - lcp[opener], spans) + np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
        self.end[at] = np.repeat(ends, spans)
        self.crossing = np.flatnonzero((self.end == n) & (self.depth <= self.after))
        # The parent: the node before in the same row, else that of depth LCP around the row; -1 - depth for one that enters the block.
        self.parent = np.arange(len(self.row)) - 1
        heads = np.flatnonzero(opened > 0)
        around = smaller[heads]
        within = self.start[around] + lcp[heads] - lcp[around] - 1
        self.parent[self.start[heads]] = np.where(around >= 0, within, -1 - lcp[heads])
        inside = self.parent[self.parent >= 0]
        self.children = np.bincount(inside, minlength=len(self.row))
        self.incoming = int(borders.lcp[k])
        self.children_in = np.bincount(-1 - self.parent[self.parent < 0], minlength=self.incoming + 1)[1:]
        low = np.minimum.accumulate(lcp)
        self.rows_in = n - np.searchsorted(low[::-1], np.arange(1, self.incoming + 1), "left")  # of entering nodes
        self.count = self.end - self.row
        self.smallest = RangeMin(self.convs).least(self.row, self.end - 1) if len(self.row) else self.row
        self.smallest_in = np.minimum.accumulate(self.convs)[self.rows_in - 1]

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of stretches of equal rows."""
        starts = np.flatnonzero((self.opened > 0) | (np.arange(self.n) == 0))
        return starts, np.append(starts[1:], self.n)

    def ids(self, a: int, b: int) -> bytes:
        return ",".join(map(str, self.convs[a:b].tolist())).encode()


PARTS = "k long, owner long, depth long, n_convs long, conv_id long, n_children long, words long"


def _count_parts(shared):
    """Each block's part of the rows and children of nodes that cross its borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row, borders)
                c, m = b.crossing, b.incoming
                columns = [
                    (borders.owners(b.k), np.full(len(c), b.k)),
                    (np.arange(1, m + 1), b.depth[c]),
                    (b.rows_in, b.count[c]),
                    (b.smallest_in, b.smallest[c]),
                    (b.children_in, b.children[c]),
                    (np.zeros(m, np.int64), b.words[c]),
                ]
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), b.k, np.int64)), *columns], ["k", "owner", "depth", "n_convs", "conv_id", "n_children", "words"])

    return run


OUT = "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, owner long, k long, ids binary"
NODES, SUMS, ENDS = 0, 1, 2


def _nodes(shared):
    """A block's own nodes; and its parts of the sums and of the ids of nodes that cross its borders."""
    schema = pa.schema([(x.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for x in OUT.split(", ")])

    def rows(kind: int, n: int, **columns) -> pa.RecordBatch:
        columns["kind"] = pa.array(np.full(n, kind, np.int32))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row, borders)
                for x in row["own"] or ():  # what all blocks together have of the nodes that leave this one
                    f = b.crossing[x["depth"] - int(b.depth[b.crossing[0]])]
                    b.count[f], b.children[f], b.smallest[f] = x["n_convs"], x["n_children"], x["conv_id"]
                entering = np.zeros(b.incoming + 1, np.int64)
                for x in row["entering"] or ():
                    entering[x["depth"]] = x["conv_id"]
                saved = np.concatenate([[0], np.cumsum((b.count - 1) * b.words)])
                leaves = np.concatenate([[0], np.cumsum(b.children == 0)])
                parents = np.where(b.parent >= 0, b.smallest[np.maximum(b.parent, 0)] if len(b.smallest) else 0, entering[np.maximum(-1 - b.parent, 0)])
                orphan = b.depth == 1
                ends = [EMPTY] * len(b.row)
                chunks, crosses = [], np.zeros(len(b.row), bool)
                crosses[b.crossing] = True
                for a, z in zip(*(x.tolist() for x in b.groups()), strict=True):
                    d = int(b.length[a])
                    if b.opened[a] == 0:  # equal to the rows before the block
                        chunks.append((int(borders.owners(b.k)[d - 1]), d, b.ids(a, z)))
                        continue
                    node = int(b.start[a + 1]) - 1
                    if crosses[node]:
                        chunks.append((b.k, d, b.ids(a, z)))
                    else:
                        ends[node] = hashlib.sha256(b.ids(a, z)).hexdigest()
                f = np.flatnonzero(~crosses)
                last = b.start[b.end[f]]
                yield rows(
                    NODES, len(f), conv_id=b.smallest[f], depth=b.depth[f] - 1, parent_conv_id=pa.array(parents[f], mask=orphan[f]), n_convs=b.count[f], n_children=b.children[f],
                    n_leaves=leaves[last] - leaves[f], saved_tokens=saved[last] - saved[f], ends_sha256=[ends[i] for i in f.tolist()],
                )
                c, top, m = b.crossing, b.start[-1], b.incoming
                within = b.start[b.rows_in]
                yield rows(SUMS, m, owner=borders.owners(b.k), depth=np.arange(1, m + 1), n_leaves=leaves[within], saved_tokens=saved[within])
                yield rows(SUMS, len(c), owner=np.full(len(c), b.k), depth=b.depth[c], n_leaves=leaves[top] - leaves[c], saved_tokens=saved[top] - saved[c], parent_conv_id=pa.array(parents[c], mask=orphan[c]))
                if chunks:
                    yield rows(ENDS, len(chunks), owner=[x[0] for x in chunks], depth=[x[1] for x in chunks], ids=[x[2] for x in chunks], k=[b.k] * len(chunks))

    return run


EMPTY = hashlib.sha256(b"").hexdigest()


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node, from its ids in pieces and in order."""
    now, digest = None, None
    for batch in batches:
        done = []
        for owner, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if now == (owner, depth):
                digest.update(b",")
            else:
                if now:
                    done.append((*now, digest.hexdigest()))
                now, digest = (owner, depth), hashlib.sha256()
            digest.update(ids)
        yield _ended(done)
    if now:
        yield _ended([(*now, digest.hexdigest())])


def _ended(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["owner", "depth", "ends_sha256"])


def prefix_trie(convs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each distinct prefix of the conversations (conv_id long, turns array of structs with digest and words):

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (childless nodes of
    the subtree), saved_tokens (over the subtree, members but one times words of the node's last turn), ends_sha256 (of
    the ids, ascending and comma-joined, of members that end here; of nothing if there are none).

    Turns are equal if their digests are (MD5 of role and text). Conversations without turns are members of the root alone, whose turns may
    be null; repeated rows are members twice; rows without conv_id are left out; other columns are ignored; no conversations give no rows. A conversation's
    digests, 16 bytes a turn, are in one row. Ids that end at one node are hashed in order by one task, as pieces of a block each.
    """
    spark = convs.sparkSession
    turns = F.coalesce("turns", F.array().cast(convs.schema["turns"].dataType))
    key = F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), ""))
    rows = convs.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), key.alias("key"), F.transform(turns, lambda t: t["words"].cast("long")).alias("words"))
    rows, rows_path = written(rows, "trie-rows")
    total = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    parts = max(-(-total // block_turns), 1)
    ordered = rows.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    blobs = ", ".join(f"{c} binary" for c in BLOCK_COLUMNS[4:])
    blocks, blocks_path = written(ordered.mapInArrow(tidy(_blocks), f"block long, first binary, last binary, least long, {blobs}"), "trie-blocks")
    discard(spark, rows_path)
    numbers = sorted(r.block for r in blocks.select("block").toLocalIterator())  # one number a block
    if not numbers:
        discard(spark, blocks_path)
        return spark.createDataFrame([], ", ".join(f"{c} {'string' if c == NODE[-1] else 'long'}" for c in NODE))
    order = spark.createDataFrame([(b, k, numbers[k - 1] if k else -1) for k, b in enumerate(numbers)], "block long, k long, before long")
    placed = blocks.select("block", "first", "least").join(order, "block")
    met = placed.join(blocks.select(F.col("block").alias("before"), "last"), "before").select("k", "least", "last", "first")
    lcp, least = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    for r in met.mapInArrow(_border, "block long, least long, lcp long").toLocalIterator():
        lcp[r.block] = r.lcp + 1
        least[r.block] = min(r.lcp + 1, r.lcp + 1 if r.least is None else r.least + 1)
    borders = spark.sparkContext.broadcast(Borders(lcp, least))
    work = blocks.drop("first", "last", "least").join(order.select("block", "k"), "block").drop("block")
    counted, counted_path = written(work.mapInArrow(tidy(_count_parts(borders)), PARTS), "trie-parts")
    crossing = stored(counted.groupBy("owner", "depth").agg(*[F.sum(c).alias(c) for c in ("n_convs", "n_children", "words")], F.min("conv_id").alias("conv_id")), "trie-crossing")
    own = crossing.groupBy(F.col("owner").alias("k")).agg(F.collect_list(F.struct("depth", "n_convs", "n_children", "conv_id")).alias("own"))
    at = counted.where("k <> owner").select("k", "owner", "depth").join(crossing.select("owner", "depth", "conv_id"), ["owner", "depth"])
    entering = at.groupBy("k").agg(F.collect_list(F.struct("depth", "conv_id")).alias("entering"))
    found = stored(work.join(own, "k", "left").join(entering, "k", "left").mapInArrow(tidy(_nodes(borders)), OUT), "trie-nodes")
    for path in (blocks_path, counted_path):  # what is left of them is in the nodes
        discard(spark, path)
    sums = found.where(F.col("kind") == SUMS).groupBy("owner", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("parent_conv_id").alias("parent_conv_id"))
    pieces = found.where(F.col("kind") == ENDS).select("owner", "depth", "k", "ids")
    pieces = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "k")
    ends = pieces.mapInArrow(_hash_ends, "owner long, depth long, ends_sha256 string")
    across = crossing.join(sums, ["owner", "depth"]).join(ends, ["owner", "depth"], "left")
    across = across.withColumn("depth", F.col("depth") - 1).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    return found.where(F.col("kind") == NODES).select(*NODE).union(across.select(*NODE))
