"""Packing of token sequences into fixed windows by linear grouping.

Within a bounded shard of pieces:

1. Large pieces are sorted by length and dealt into GROUPS groups of equal cardinality; every length
   is rounded up to the largest of its group, which leaves few sizes.
2. Configurations (multisets of those sizes that fit a window) are optimised by a linear
   programme: the fewest windows that hold all sizes as often as they are asked for. Its columns
   are generated as they are needed, each by a knapsack over the sizes' prices.
3. Every configuration is used as often as the programme says, rounded down; actual pieces take the
   places of their group's size, longest first, so windows keep more room than planned.
4. Windows that came out less full than one of FULL are taken apart again. What is left, small pieces
   above all, goes best-fit into the fullest window that still has room.

Each value of FULL, and best-fit decreasing over all pieces, gives a packing; that with the fewest windows is kept.

Shards hold a random share of all pieces each, of bounded count, so that no task grows with the
input and lengths are alike everywhere; a shard wastes less than a window or two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import cut, text_of, tidy
from terrane.llm._tokens import encoder

PIECES_PER_SHARD = 20_000
#: Pieces of at least this share of a window count as large.
LARGE = 1 / 8
GROUPS = 48
#: Shares of a window that a configuration's pieces must fill to stay together.
FULL = (0.0, 0.97, 0.99, 0.997)
#: Columns that are generated at most; the programme is then as good as they allow.
MOST_COLUMNS = 400


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of sizes that fit the capacity and have the highest total price."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int16)
    for i, (w, v) in enumerate(zip(sizes.tolist(), prices.tolist(), strict=True)):
        if v <= 1e-12:
            continue
        base = best
        for k in range(1, capacity // w + 1):
            with_k = np.full(capacity + 1, -np.inf)
            with_k[k * w :] = base[: capacity + 1 - k * w] + k * v
            better = with_k > best + 1e-12
            best = np.where(better, with_k, best)
            taken[i][better] = k
    out, at = np.zeros(len(sizes), np.int64), int(np.argmax(best))
    for i in range(len(sizes) - 1, -1, -1):
        out[i] = taken[i][at]
        at -= int(out[i]) * int(sizes[i])
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations of few sizes and how often each is used, by the linear programme and rounded down; together they hold no more than the demand.

    Revised simplex with columns generated by a knapsack over the dual prices, from configurations of one size each.
    """
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(MOST_COLUMNS):
        inverse = np.linalg.inv(basis)
        column = _knapsack(sizes, inverse.sum(0), capacity)  # every configuration costs one window
        if inverse.sum(0) @ column <= 1 + 1e-7:
            break
        amounts, change = np.maximum(inverse @ demand, 0), inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(change > 1e-9, amounts / change, np.inf)
        leaves = int(np.argmin(ratio))
        basis[:, leaves] = column
    amounts = np.floor(np.linalg.solve(basis, demand.astype(float)) + 1e-7).astype(np.int64)
    left, used = demand.copy(), []
    for j in np.argsort(-amounts, kind="stable"):
        column = basis[:, j].astype(np.int64)
        held = column > 0
        times = min(int(amounts[j]), int((left[held] // column[held]).min()))
        if times > 0:
            used.append((column, times))
            left -= times * column
    return used


class BestFit:
    """Windows by remaining room; a piece goes into the fullest one that has room for it."""

    def __init__(self, room: list[int], capacity: int):
        self.capacity, self.room = capacity, room
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.has = np.zeros(capacity + 2, bool)
        for b, r in enumerate(room):
            self.put(b, r)

    def put(self, b: int, r: int) -> None:
        self.by_room[r].append(b)
        self.has[r] = True
        self.room[b] = r

    def place(self, length: int) -> int:
        r = length + int(np.argmax(self.has[length:]))
        if r <= self.capacity and self.has[r]:
            b = self.by_room[r].pop()
            self.has[r] = bool(self.by_room[r])
        else:
            b, r = len(self.room), self.capacity
            self.room.append(r)
        self.put(b, r - length)
        return b


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of every piece, longest first into the fullest window that has room."""
    window, offset, fit = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), BestFit([], capacity)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        window[i] = b = fit.place(n)
        offset[i] = capacity - fit.room[b] - n
    return window, offset


def linear_grouping(lengths: np.ndarray, capacity: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Window and offset of every piece by grouped sizes and optimised configurations, for each share in FULL."""
    first, place = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = order[lengths[order] == capacity]
    first[full] = np.arange(len(full))
    order = order[len(full) :]
    large = order[lengths[order] >= max(1, int(capacity * LARGE))]
    fills = [np.full(len(full), capacity, np.int64)]
    if len(large):
        groups = np.array_split(large, min(GROUPS, len(large)))
        tops = np.array([lengths[g[0]] for g in groups])
        sizes, member = np.unique(tops, return_inverse=True)
        queues = [np.concatenate([g for g, m in zip(groups, member, strict=True) if m == i]) for i in range(len(sizes))]
        at, base = np.zeros(len(sizes), np.int64), len(full)
        for column, times in configurations(sizes, np.array([len(q) for q in queues]), capacity):
            fill = np.zeros(times, np.int64)
            for i in np.flatnonzero(column)[::-1]:
                for _ in range(int(column[i])):
                    mine = queues[i][at[i] : at[i] + times]
                    at[i] += times
                    first[mine], place[mine] = base + np.arange(times), fill
                    fill += lengths[mine]
            base += times
            fills.append(fill)
    filled = np.concatenate(fills)
    out = []
    for share in FULL:
        stays = filled >= share * capacity
        number = np.append(np.where(stays, np.cumsum(stays) - 1, -1), -1)  # the last is that of pieces without a window
        window, offset = number[first], place.copy()
        fit = BestFit((capacity - filled[stays]).tolist(), capacity)
        for i in order[window[order] < 0]:
            n = int(lengths[i])
            b = fit.place(n)
            window[i], offset[i] = b, capacity - fit.room[b] - n
        out.append((window, offset))
        if stays.all() and (len(fit.room) * capacity - int(lengths.sum())) < capacity:
            break
    return out


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of every piece; lengths are 1 to capacity. Never more windows than best-fit decreasing."""
    found = [*linear_grouping(lengths, capacity), best_fit_decreasing(lengths, capacity)]
    return min(found, key=lambda x: x[0].max(initial=-1))


PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, window: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, out = batch.column(0), ([], [], [], [], [], [])
            for row, raw in enumerate(encoder(path).encode(batch.column(1).to_pylist())):
                raw += end
                n = len(raw) // 4
                head = n % window or window
                for p, a in enumerate([0, *range(head, n, window)]):
                    b = head if p == 0 else a + window
                    part = raw[4 * a : 4 * b]
                    for x, v in zip(out, (row, p, a, b - a, zlib.crc32(part), part if with_ids else None), strict=True):
                        x.append(v)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(x, t) for x, t in zip(out[1:], kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            columns, names = (columns, names) if with_ids else (columns[:-1], names[:-1])
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(out[0], pa.int64())), *columns], names)

    return run


def _pack(window: int):
    def run(rows):
        order = np.lexsort([rows.column(c).to_numpy(zero_copy_only=False) for c in ("ids_crc32", "start", "length")])
        rows = rows.take(pa.array(order))
        where, offset = pack_lengths(rows.column("length").to_numpy(), window)
        shard = rows.column("shard")[0].as_py()
        rows = rows.append_column("sequence_id", pa.array((shard << 32) + where, pa.int64()))
        return rows.append_column("offset", pa.array(offset, pa.int64())).drop_columns(["shard"])

    return run


def pack_documents(docs: DataFrame, path: str, window: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids: little-endian uint32) of every piece.

    A document is its text's ids (tokenizer file ``path``) and ``end_id``; null and empty texts are
    the end id alone. Longer ones than ``window`` are cut into pieces of the window's length, the
    first of which takes the rest. Sequence numbers are unique and have gaps. Null ids stay null,
    repeated rows are documents of their own, other columns are ignored, an empty table gives no
    rows. Token ids cross no shuffle unless they are asked for.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()) + (", ids binary" if with_ids else "")
    pieces = cut(rows.mapInArrow(tidy(_cut(path, window, end_id, with_ids)), schema))
    shards = max(1, -(-pieces.count() // PIECES_PER_SHARD))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))  # of the checkpoint: equal rows part
    return dealt.groupBy("shard").applyInArrow(_pack(window), schema + ", sequence_id long, offset long")
