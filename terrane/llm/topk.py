"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments; each keeps its mean and deviation. For two vectors with segments of
m components, ``sum m * (mu_q mu_c + sd_q sd_c)`` bounds the inner product from above, which is the
same as bounding the distance from below, since |q - c|^2 = |q|^2 + |c|^2 - 2 q.c. One segment,
then 4, then 16 give tighter and tighter bounds; a pair whose bound is below the query's k-th
best score so far goes, and survivors get their exact integer score.

Vectors of a kind stand together, in packed blocks. A block's envelope (the range of the means and
the largest deviation of each segment) bounds the scores of two blocks:

1. Every query block meets the candidate blocks with the best such bounds, which gives each query a
   k-th best score that all other blocks share.
2. A pair of blocks whose bound is below the k-th best of all its queries is dropped before
   anything but envelopes has been sent.
3. What is left is searched: a candidate block is sent once to a group of query blocks, and a task
   holds one such group, of bounded count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm._common import cut, stored

LEVELS = (1, 4, 16)
#: Candidates whose exact score seeds the k-th best of a query within a block.
SEEDS = 32
#: Candidate blocks that each query block meets first.
FIRST_BLOCKS = 2
#: Vectors that name the kinds, at most; a bounded sample that only affects which vectors stand together.
KINDS = 256
QUERY_ROWS = 1024
#: Query blocks that a candidate block meets in one task.
QUERIES_AT_ONCE = 32
#: Share of surviving pairs up to which they are computed one by one.
SPARSE = 0.15
BLOCK = "dim int, n int, width int, ids binary, rows binary, low binary, high binary, spread binary, norm double"


def _usable(batch: pa.RecordBatch, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and integer rows of the vectors that take part, by their number of components."""
    vectors, ids = batch.column(1), batch.column(0)
    flat = vectors.flatten()  # of null vectors there is nothing in it
    at = np.concatenate([[0], np.cumsum(np.asarray(vectors.value_lengths().fill_null(0)))])
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan))
    fine = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (fine[at[1:]] == fine[at[:-1]]) & np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    numbers, lengths = np.asarray(ids.fill_null(0)), np.diff(at)
    out = {}
    for dim in np.unique(lengths[good]):
        mine = np.flatnonzero(good & (lengths == dim))
        rows = values[at[mine][:, None] + np.arange(dim)]
        out[int(dim)] = numbers[mine], np.floor(scale * rows).astype(np.int64)
    return out


def _narrow(rows: np.ndarray) -> tuple[int, bytes]:
    most = int(np.abs(rows).max(initial=0))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return width, rows.astype(f"<i{width}").tobytes()


def _named(scale: float, kinds: dict[int, np.ndarray]):
    """(dim, kind, id, width, row): kind is the sampled vector of that length with the best inner product."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (ids, rows) in _usable(batch, scale).items():
                known = kinds.get(dim)
                kind = np.zeros(len(ids), np.int64) if known is None else np.argmax(rows.astype(np.float64) @ known.T, axis=1)
                packed = [rows[i].astype("<i8").tobytes() for i in range(len(ids))] if dim else [b""] * len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(ids), pa.int32()), pa.array(kind.astype(np.int32)), pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], ["dim", "kind", "id", "row"])

    return run


def segments(rows: np.ndarray, k: int) -> np.ndarray:
    """Means, then deviations, of k segments, times the root of a segment's length."""
    m = max(1, -(-rows.shape[1] // k))
    parts = np.pad(rows, ((0, 0), (0, m * k - rows.shape[1]))).reshape(len(rows), k, m)
    return np.concatenate([parts.mean(2), parts.std(2)], 1) * np.sqrt(m)


def _pack(size: int):
    """Rows come sorted by dim and kind; a block holds rows of one dim that stand next to each other."""

    def block(dim: int, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        stats = segments(rows.astype(np.float64), LEVELS[-1])
        means, spreads = stats[:, : LEVELS[-1]], stats[:, LEVELS[-1] :]
        width, raw = _narrow(rows)
        values = (dim, len(ids), width, ids.astype("<i8").tobytes(), raw, means.min(0).tobytes(), means.max(0).tobytes(), spreads.max(0).tobytes(), float(np.linalg.norm(rows.astype(np.float64), axis=1).max()))
        kinds = (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.float64())
        names = [x.split()[0] for x in BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        now, n = -1, 0

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            if not held:
                return
            ids, rows = (np.concatenate(x) for x in zip(*held, strict=True))
            end = len(ids) // least * least
            for i in range(0, end, size):
                yield block(now, ids[i : min(i + size, end)], rows[i : min(i + size, end)])
            held, n = [(ids[end:], rows[end:])] if end < len(ids) else [], len(ids) - end

        for batch in batches:
            dims, ids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                if dim != now:
                    yield from flush(1)
                    now = int(dim)
                raw = b"".join(batch.column(3).take(pa.array(mine)).to_pylist())
                held.append((ids[mine], np.frombuffer(raw, "<i8").reshape(len(mine), now)))
                n += len(mine)
                if n >= size:
                    yield from flush(size)
        yield from flush(1)

    return run


def _bound(low_q, high_q, spread_q, low_c, high_c, spread_c) -> np.ndarray:
    """The largest inner product that rows of two blocks can have."""
    corners = [a * b for a in (low_q, high_q) for b in (low_c, high_c)]
    return (np.maximum.reduce(corners) + spread_q * spread_c).sum(1)


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index
        parts = [np.frombuffer(b"".join(batch.column(at(f"{x}_{y}")).to_pylist()), np.float64).reshape(-1, LEVELS[-1]) for y in "qc" for x in ("low", "high", "spread")]
        slack = 1e-9 * batch.column(at("norm_q")).to_numpy() * batch.column(at("norm_c")).to_numpy() + 1e-6
        yield pa.RecordBatch.from_arrays([batch.column(at("q")), batch.column(at("c")), pa.array(_bound(*parts) + slack)], ["q", "c", "bound"])


def exact(q: np.ndarray, c: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of rows; as floats where those are exact."""
    safe = q.shape[1] * int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) < 1 << 53
    if safe and len(qi) > SPARSE * len(q) * len(c):
        return (q.astype(np.float64) @ c.astype(np.float64).T)[qi, ci].astype(np.int64)
    out, step = np.empty(len(qi), np.int64), max(1, (1 << 21) // max(1, q.shape[1]))
    for i in range(0, len(qi), step):
        s = slice(i, i + step)
        out[s] = np.einsum("ij,ij->i", q[qi[s]], c[ci[s]])
    return out


def search_block(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Query index, candidate id and score of each query's k best in this block, ties to smaller ids.

    ``least``: scores below which nothing is wanted. Also the pairs that were left after each level.
    """
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    slack = 1e-9 * np.linalg.norm(qf, axis=1)[:, None] * np.linalg.norm(cf, axis=1)[None, :] + 1e-6
    least = np.full(len(q), -np.inf) if least is None else least.astype(np.float64)
    coarse = segments(qf, LEVELS[0]) @ segments(cf, LEVELS[0]).T + slack
    coarse[q_ids[:, None] == c_ids[None, :]] = -np.inf
    open_ = np.flatnonzero(np.isneginf(least))
    if len(open_):
        n = min(SEEDS, len(c))
        seed = np.argpartition(-coarse[open_], n - 1, axis=1)[:, :n]
        scores = exact(q[open_], c, np.repeat(np.arange(len(open_)), n), seed.ravel()).astype(np.float64).reshape(len(open_), n)
        scores[np.isneginf(np.take_along_axis(coarse[open_], seed, 1))] = -np.inf
        if n >= k:
            least[open_] = -np.sort(-scores, axis=1)[:, k - 1]
    qi, ci = np.nonzero((coarse >= least[:, None]) & ~np.isneginf(coarse))
    left = [len(qi)]
    for level in LEVELS[1:]:
        a, b = segments(qf, level), segments(cf, level)
        if len(qi) > SPARSE * len(q) * len(c):
            keep = (a @ b.T + slack)[qi, ci] >= least[qi]
        else:
            keep, step = np.empty(len(qi), bool), (1 << 21) // a.shape[1]
            for i in range(0, len(qi), step):
                x, y = qi[i : i + step], ci[i : i + step]
                keep[i : i + step] = np.einsum("ij,ij->i", a[x], b[y]) + slack[x, y] >= least[x]
        qi, ci = qi[keep], ci[keep]
        left.append(len(qi))
    score = exact(q, c, qi, ci)
    good = score >= least[qi]
    qi, ci, score = qi[good], ci[good], score[good]
    order = np.lexsort((c_ids[ci], -score, qi))
    qi, ci, score = qi[order], ci[order], score[order]
    first = np.searchsorted(qi, qi)  # where each query's rows begin
    top = np.arange(len(qi)) - first < k
    return qi[top], c_ids[ci[top]], score[top], left


def _search(k: int):
    def run(key, blocks, asked):
        c_ids = np.frombuffer(blocks.column("ids")[0].as_py(), "<i8")
        dim, width = blocks.column("dim")[0].as_py(), blocks.column("width")[0].as_py()
        c = np.frombuffer(blocks.column("rows")[0].as_py(), f"<i{width}").reshape(len(c_ids), dim).astype(np.int64)
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for row in asked.to_pylist():
            q_ids = np.frombuffer(row["q_ids"], "<i8")
            q = np.frombuffer(row["q_rows"], f"<i{row['q_width']}").reshape(len(q_ids), dim).astype(np.int64)
            least = None
            if row["least"] is not None:
                least = np.full(len(q_ids), -np.inf)
                for x in row["least"]:
                    least[x["i"]] = x["score"]
            at, ids, scores, _ = search_block(q, q_ids, c, c_ids, k, least)
            for x, v in zip(out, (np.full(len(at), row["q"]), at, q_ids[at], ids, scores), strict=True):
                x.append(v)
        return pa.table([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["q", "i", "query_id", "vec_id", "score"])

    return run


def pairs_of_blocks(asked: DataFrame, candidates: DataFrame, parts: int) -> DataFrame:
    """q, c, bound of every pair of blocks with rows of one length, from their envelopes alone."""
    envelope = ("low", "high", "spread", "norm")
    a = asked.select("q", "dim", *[F.col(x).alias(f"{x}_q") for x in envelope], F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    b = candidates.select("c", "dim", *[F.col(x).alias(f"{x}_c") for x in envelope], F.pmod("c", F.lit(parts)).cast("int").alias("part"))
    return a.join(b, ["part", "dim"]).drop("part", "dim").mapInArrow(_bounds, "q long, c long, bound double")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k highest integer inner products, ties to smaller ids.

    A component x counts as floor(scale * x). A query never meets rows with its own id. Vectors
    that are null or hold null, NaN or infinite components, and rows without an id, take no part;
    vectors of unlike length never meet. Repeated rows are candidates of their own, and a repeated
    query row gives its results again. Fewer than k candidates give all of them. Scores must fit
    64 bits. Other columns are ignored; empty tables give no rows.
    """
    n = max(1, -(-vectors.count() // block_rows))
    some: dict[int, np.ndarray] = {}
    if n > 1:
        sample = vectors.select(F.col(id_col), F.col(vec_col)).orderBy(F.xxhash64(id_col)).limit(min(KINDS, 4 * n)).toArrow()
        for batch in sample.to_batches():
            some.update((dim, rows.astype(np.float64)) for dim, (_, rows) in _usable(batch, scale).items())

    def packed(df: DataFrame, size: int, name: str) -> DataFrame:
        parts = max(1, -(-n * block_rows // max(size, block_rows)))
        rows = df.select(F.col(id_col).cast("long"), F.col(vec_col)).mapInArrow(_named(scale, some), "dim int, kind int, id long, row binary")
        dealt = rows.repartitionByRange(parts, "dim", "kind", F.xxhash64("id", "row")).sortWithinPartitions("dim", "kind")
        return cut(dealt.mapInArrow(_pack(size), BLOCK).withColumn(name, F.monotonically_increasing_id()))

    candidates = packed(vectors, block_rows, "c")
    asked = packed(queries, QUERY_ROWS, "q")

    def searched(pairs: DataFrame, least: DataFrame | None) -> DataFrame:
        mine = asked.select("q", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("width").alias("q_width"))
        mine = mine.join(least, "q", "left") if least is not None else mine.withColumn("least", F.lit(None).cast("array<struct<i:long,score:long>>"))
        number = F.row_number().over(Window.partitionBy("c").orderBy("q")) - 1  # of query blocks that meet a candidate block
        met = pairs.withColumn("part", F.floor(number / QUERIES_AT_ONCE)).select("c", "q", "part")
        left = met.select(F.col("c").alias("block"), F.col("part").alias("share")).distinct().join(candidates.select(F.col("c").alias("block"), "dim", "width", "ids", "rows"), "block")
        right = met.join(mine, "q")
        found = left.groupBy("block", "share").cogroup(right.groupBy("c", "part")).applyInArrow(_search(k), "q long, i long, query_id long, vec_id long, score long")
        return found

    bounds = stored(pairs_of_blocks(asked, candidates, n), "topk-bounds")
    order = Window.partitionBy("q").orderBy(F.desc("bound"), "c")
    first = bounds.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= FIRST_BLOCKS)
    seeds = stored(searched(first, None), "topk-found")
    best = seeds.groupBy("q", "i").agg(F.slice(F.sort_array(F.collect_list("score"), asc=False), k, 1).alias("kth")).where("size(kth) = 1")
    least = best.groupBy("q").agg(F.collect_list(F.struct("i", F.col("kth")[0].alias("score"))).alias("least"))  # at most QUERY_ROWS
    rows_asked = asked.select("q", F.col("n").alias("n_asked"))
    bar = least.select("q", F.array_min(F.col("least.score")).alias("bar"), F.size("least").alias("n_least")).join(rows_asked, "q").where("n_least = n_asked").select("q", "bar")
    rest = bounds.join(first.select("q", "c"), ["q", "c"], "left_anti").join(bar, "q", "left").where("bar is null or bound >= bar")
    found = seeds.union(searched(rest, least))
    best = Window.partitionBy("q", "i").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
