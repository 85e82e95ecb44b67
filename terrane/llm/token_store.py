"""Token ids in Huffman-coded files.

1. Texts become ids (tokenizers library), kept in the shared folder; global counts give one
   canonical code, length-limited by package-merge.
2. Every document is coded on its own and dealt to a part: a range of ids of bounded size. An id that
   fills several parts, or null, is dealt over them. A task sorts its parts and writes blocks. A block decodes without any other; inside it, checkpoints hold the bit offset of
   every 128th id of a document, so that a table decodes all of a block's stretches side by side.
3. Reading gives back the ids; the number of ids before a document comes from counts of blocks.

The files are Parquet with one row a block, so any store that Spark reaches will do; ``blob`` is
self-contained but for the code lengths, of which the file set has one row.

Block: magic "THF1", then little-endian uint32 number of documents D, of ids, of checkpoints C;
D times int64 document id, uint8 whether the id is null, uint32 number of ids, uint32 bytes of
code; C times uint32 bit offset within the document's code; the codes, each padded to a byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.llm._common import fresh_path, stored, text_of
from terrane.llm._tokens import encoder

STRIDE = 128
LIMIT = 16
BLOCK_IDS = 1 << 20
RANGE_IDS = 1 << 22


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (more if the symbols need them) by package-merge; 0: unused."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    limit = max(limit, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.empty(0, np.int64)
    for _ in range(limit):
        weights = np.concatenate([leaves, packages])
        rank = np.argsort(weights, kind="stable")
        levels.append(np.cumsum(rank < n))  # leaves among the first items
        merged = weights[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    take, lengths = 2 * n - 2, np.zeros(n, np.int64)
    for leaf_count in reversed(levels):
        if not take:
            break
        mine = int(leaf_count[take - 1])
        lengths[:mine] += 1
        take = 2 * (take - mine)
    out[order] = lengths
    return out


class Codebook:
    """The canonical code of a table of lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.limit = int(lengths.max(initial=1))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = 1 << (self.limit - self.lengths[order])
        starts = np.concatenate([[0], np.cumsum(spans)])
        if starts[-1] > 1 << self.limit:
            raise ValueError("the lengths are no prefix code")
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = starts[:-1] >> (self.limit - self.lengths[order])
        self.symbol = np.zeros(1 << self.limit, np.uint32)
        self.step = np.ones(1 << self.limit, np.uint8)
        self.symbol[: starts[-1]] = np.repeat(order, spans)
        self.step[: starts[-1]] = np.repeat(self.lengths[order], spans)

    def encode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Codes of documents that end at ``ends``: bytes, bytes by document, checkpoints, checkpoints by document."""
        lengths, sizes = self.lengths[ids], np.diff(ends, prepend=0)
        bits = np.concatenate([[0], np.cumsum(lengths)])
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        n_bytes = (bits[ends] - bits[begins] + 7) // 8
        shift = np.concatenate([[0], np.cumsum(n_bytes)])[:-1] * 8 - bits[begins]
        at = bits[:-1] + np.repeat(shift, sizes)
        word, offset = at >> 5, (at & 31).astype(np.uint64)
        value = self.codes[ids] << (np.uint64(64) - offset - lengths.astype(np.uint64))
        out = np.zeros(int(n_bytes.sum()) // 4 + 3, np.uint32)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        if len(first):
            out[word[first]] |= np.bitwise_or.reduceat((value >> np.uint64(32)).astype(np.uint32), first)
            out[word[first] + 1] |= np.bitwise_or.reduceat((value & np.uint64(0xFFFFFFFF)).astype(np.uint32), first)
        n_points = -(-sizes // STRIDE)
        points = np.concatenate([np.arange(b, e, STRIDE) for b, e in zip(begins, ends, strict=True)]) if len(ends) else begins
        relative = bits[points] - np.repeat(bits[begins], n_points)
        return out.byteswap().tobytes()[: int(n_bytes.sum())], n_bytes, relative.astype("<u4"), n_points

    def decode(self, code: np.ndarray, start_bits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of stretches that begin at these bits and have these counts, all side by side."""
        if not len(counts):
            return np.empty(0, np.uint32)
        wide = np.concatenate([code, np.zeros(8, np.uint8)]).astype(np.uint32)
        wide = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
        out = np.empty((int(counts.max()), len(counts)), np.uint32)
        at, last, down = start_bits.astype(np.int64), len(wide) * 8 - 1, np.uint32(32 - self.limit)
        for k in range(len(out)):
            slot = (wide[at >> 3] << (at & 7).astype(np.uint32)) >> down
            out[k] = self.symbol[slot]
            at = np.minimum(at + self.step[slot], last)
        return out.T[np.arange(len(out))[None, :] < counts[:, None]]


def pack_block(doc_ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray, points: list[bytes], codes: list[bytes]) -> bytes:
    head = np.array([len(doc_ids), int(sizes.sum()), sum(map(len, points)) // 4], "<u4")
    lengths = np.array([len(x) for x in codes], "<u4")
    return b"".join([b"THF1", head.tobytes(), doc_ids.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), sizes.astype("<u4").tobytes(), lengths.tobytes(), *points, *codes])


def unpack_block(blob: bytes, book: Codebook) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, which are null, numbers of ids, and all ids of a block."""
    if blob[:4] != b"THF1":
        raise ValueError("not a block of token ids")
    d, _, c = np.frombuffer(blob, "<u4", 3, 4).tolist()
    at, parts = 16, []
    for kind, n in (("<i8", d), ("u1", d), ("<u4", d), ("<u4", d), ("<u4", c), ("u1", -1)):
        parts.append(np.frombuffer(blob, kind, n, at))
        at += parts[-1].nbytes
    doc_ids, nulls, sizes, lengths, points, code = parts
    n_points = -(-sizes.astype(np.int64) // STRIDE)
    begin = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])[:-1] * 8
    counts = np.full(c, STRIDE)
    ends = np.cumsum(n_points)[n_points > 0] - 1
    counts[ends] = (sizes[n_points > 0].astype(np.int64) - 1) % STRIDE + 1
    return doc_ids, nulls.astype(bool), sizes.astype(np.int64), book.decode(code, np.repeat(begin, n_points) + points, counts)


def _tokenise(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            raw = [x + end for x in encoder(path).encode(batch.column(1).to_pylist())]
            ids = np.frombuffer(b"".join(raw), "<u4")
            width = 2 if ids.max(initial=0) < 1 << 16 else 4
            narrow, cuts = ids.astype(f"<u{width}").tobytes(), np.cumsum([0, *(len(x) // 4 * width for x in raw)])
            packed = [narrow[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([width] * len(raw), pa.int32()), pa.array(packed, pa.binary())], ["doc_id", "width", "ids"])

    return run


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of packed rows, and where each row's ids end."""
    raw, widths = batch.column(batch.schema.get_field_index("ids")).to_pylist(), batch.column(batch.schema.get_field_index("width")).to_pylist()
    parts = [np.frombuffer(x, f"<u{w}") for x, w in zip(raw, widths, strict=True)]
    return np.concatenate(parts or [np.empty(0, "<u2")]).astype(np.int64), np.cumsum([len(x) for x in parts], dtype=np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        found = np.bincount(_ids(batch)[0])
        total = np.pad(total, (0, max(0, len(found) - len(total))))
        total[: len(found)] += found
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def _code(lengths: np.ndarray, bounds: np.ndarray, null_parts: int):
    """Code each document and name its part. Parts of null ids come first; an id that is a bound may be on either side of it, and is dealt out in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, seen = Codebook(lengths), 0
        for batch in batches:
            ids, ends = _ids(batch)
            code, n_bytes, points, n_points = book.encode(ids, ends)
            doc_ids = batch.column(0)
            known, turn = np.asarray(doc_ids.cast(pa.int64()).fill_null(0)), seen + np.arange(len(doc_ids))
            low, high = (np.searchsorted(bounds, known, side) for side in ("left", "right"))
            part = np.where(np.asarray(doc_ids.is_null()), turn % max(1, null_parts), null_parts + low + turn % (high - low + 1))
            seen += len(doc_ids)
            raw, a, b = points.tobytes(), np.cumsum([0, *n_bytes]), 4 * np.cumsum([0, *n_points])
            columns = [pa.array(part, pa.int64()), doc_ids.cast(pa.int64()), pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array([raw[i:j] for i, j in zip(b, b[1:], strict=False)], pa.binary()), pa.array([code[i:j] for i, j in zip(a, a[1:], strict=False)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "n", "points", "code"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part and document id; a block stays within a part."""
    held: list[tuple] = []
    state = {"part": None, "block": 0, "ids": 0}

    def flush() -> pa.RecordBatch:
        ids, sizes, points, codes = zip(*held, strict=True)
        nulls = np.array([x is None for x in ids])
        blob = pack_block(np.array([x or 0 for x in ids], np.int64), nulls, np.array(sizes), list(points), list(codes))
        out = pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (state["part"], state["block"], sum(sizes))] + [pa.array([blob], pa.binary())], ["part", "block", "n_ids", "blob"])
        held.clear()
        state.update(block=state["block"] + 1, ids=0)
        return out

    for batch in batches:
        for part, doc_id, n, points, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (part != state["part"] or state["ids"] + n > BLOCK_IDS):
                yield flush()
            if part != state["part"]:
                state.update(part=part, block=0)
            held.append((doc_id, n, points, code))
            state["ids"] += n
    if held:
        yield flush()


def write_ids(docs: DataFrame, target: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of every text, with ``end_id`` after each, into ``target``/blocks and ``target``/lengths.

    Documents are in ascending order of their integer id over parts and blocks; null ids come
    first, equal ids stand in any order, a null or empty text is the end id alone. Other columns
    are ignored; an empty table gives no block.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    ids = stored(rows.mapInArrow(_tokenise(path, end_id), "doc_id long, width int, ids binary"), "ids")
    counted = ids.select("width", "ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # at most the vocabulary
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"]] = counted["n"]
    lengths = code_lengths(counts)
    parts = max(1, -(-int(counts.sum()) // RANGE_IDS))
    rows, known = ids.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    null_parts = -(-parts * (rows - known) // max(1, rows))
    cuts = ids.where("doc_id is not null").approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 and known else []
    bounds = np.sort(np.array(cuts, np.int64))  # a frequent id several times
    coded = ids.mapInArrow(_code(lengths, bounds, null_parts), "part long, doc_id long, n long, points binary, code binary")
    ranged = coded.repartition(4 * (parts + null_parts), "part").sortWithinPartitions("part", "doc_id")  # so many that few parts share a task; ranges would code everything twice
    ranged.mapInArrow(_blocks, "part long, block long, n_ids long, blob binary").write.option("compression", "uncompressed").parquet(f"{target}/blocks")
    docs.sparkSession.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{target}/lengths")
    return target


def read_ids(spark: SparkSession, target: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids (little-endian uint32) from the files."""
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{target}/lengths").first()[0]), np.uint8)
    blocks = spark.read.schema("part long, block long, n_ids long, blob binary").parquet(f"{target}/blocks")
    sizes = blocks.select("part", "block", "n_ids")
    whole = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row a part of some 4 million ids
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = whole.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inner"))
    starts = starts.join(bases, "part").select("part", "block", (F.col("base") + F.col("inner")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths)
        for batch in batches:
            for start, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids, nulls, sizes, ids = unpack_block(blob, book)
                ends, raw = np.cumsum(sizes), ids.astype("<u4").tobytes()
                parts = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                columns = [pa.array(doc_ids, pa.int64(), mask=nulls), pa.array(start + ends - sizes), pa.array(sizes), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(parts, pa.binary())] * with_ids, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return blocks.select("part", "block", "blob").join(starts, ["part", "block"]).select("start", "blob").mapInArrow(run, schema)



def fresh_target(spark: SparkSession) -> str:
    return fresh_path(spark, "token-files")
