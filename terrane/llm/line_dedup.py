"""Removal of lines that many documents share.

1. Every document gives its distinct line keys as 128-bit hashes; their document counts are
   aggregated with map-side combining.
2. The distinct hashes are dealt to shards by hash. Each shard becomes a minimal perfect hash
   (levels of bit arrays: a key settles at the first level where it collides with no other; its
   rank among the set bits is its slot) over two compact arrays, fingerprints and counts.
3. Documents probe the arrays: their hashes go to the shards, and a task streams them past the
   one shard that it holds. A shard that frequent lines make hot is salted by its known number of
   probes. Only hits come back, keyed by the text's digest, and the text drops those lines. Texts
   that a bit table of the digests with hits clears are not joined at all.

No line is ever joined, no array collected, and memory in a task is one shard and one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import OWN, as_bytes, cut, text_of
from terrane.llm._sieve import Sieve

#: The white space that a key loses at both ends.
STRIPPED = b" \t\n\x0b\x0c\r"
KEYS_PER_SHARD = 50_000
PROBES_PER_SALT = 100_000
MASK = (1 << 64) - 1


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()  # bytes.lower() touches A-Z alone


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _mix(lo: np.ndarray, hi: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of a 128-bit key for one level."""
    x = lo ^ (hi * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((seed * 0xD6E8FEB86659FD93) & MASK)
    for shift, k in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(k)
    return x ^ (x >> np.uint64(32))


def _fingerprint(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return ((hi ^ (lo >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class LineIndex:
    """A minimal perfect hash over distinct 128-bit keys, with a fingerprint and a count per slot.

    A key of the index always gets its own count. A key outside it gets 0, but for a chance of
    2**-32 that the fingerprint of the slot it falls on is its own.
    """

    GAMMA = 1.5

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, counts: np.ndarray):
        self.levels, self.prints, self.counts = levels, prints, counts
        self.starts = np.cumsum([0] + [int(x.sum()) for x in levels])
        self.ranks = [np.cumsum(x, dtype=np.int64) - 1 for x in levels]

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray, counts: np.ndarray) -> LineIndex:
        hi, lo = hi.view(np.uint64), lo.view(np.uint64)
        left, levels = np.arange(len(hi)), []
        while len(left):
            size = max(64, int(cls.GAMMA * len(left)))
            at = (_mix(lo[left], hi[left], len(levels)) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            left = left[~bits[at]]
            if len(levels) > 200:
                raise ValueError("the keys of a shard must be distinct")
        out = cls(levels, np.zeros(len(hi), np.uint32), np.zeros(len(hi), np.int64))
        slot = out.slots(hi, lo)
        out.prints[slot], out.counts[slot] = _fingerprint(lo, hi), counts
        out.counts = out.counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))
        return out

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out = np.full(len(hi), -1, np.int64)
        left = np.arange(len(hi))
        for k, bits in enumerate(self.levels):
            at = (_mix(lo[left], hi[left], k) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            out[left[here]] = self.starts[k] + self.ranks[k][at[here]]
            left = left[~here]
        return out

    def count(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        hi, lo = hi.view(np.uint64), lo.view(np.uint64)
        slot = self.slots(hi, lo)
        out = np.zeros(len(hi), np.int64)
        known = np.flatnonzero(slot >= 0)
        known = known[self.prints[slot[known]] == _fingerprint(lo[known], hi[known])]
        out[known] = self.counts[slot[known]]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.prints), self.counts.itemsize, len(self.levels), *map(len, self.levels)], "<i8")
        return b"".join([sizes.tobytes(), *(np.packbits(x).tobytes() for x in self.levels), self.prints.tobytes(), self.counts.tobytes()])

    @classmethod
    def load(cls, blob: bytes) -> LineIndex:
        n, width, k = np.frombuffer(blob, "<i8", 3).tolist()
        sizes, at, levels = np.frombuffer(blob, "<i8", k, 24).tolist(), 24 + 8 * k, []
        for size in sizes:
            packed = np.frombuffer(blob, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        prints = np.frombuffer(blob, "<u4", n, at)
        return cls(levels, prints, np.frombuffer(blob, f"<u{width}", n, at + 4 * n))


LINES = "khi long, klo long, hi long, lo long"


def _lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, hashes = [], [], []
            for text in as_bytes(batch, "text"):
                found = {k for k in map(line_key, text.split(b"\n")) if code_points(k) >= min_chars}
                texts += [hashlib.md5(text).digest()] * len(found)
                hashes += [xxhash.xxh3_128_digest(k) for k in found]
            keys, lines = (np.frombuffer(b"".join(x), ">i8").reshape(-1, 2).astype("<i8") for x in (texts, hashes))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for x in (keys, lines) for i in (0, 1)], ["khi", "klo", "hi", "lo"])

    return run


def _build(key, rows):
    hi, lo, n = (rows.column(c).to_numpy() for c in ("hi", "lo", "n"))
    order = np.lexsort((lo, hi))
    index = LineIndex.build(hi[order].copy(), lo[order].copy(), n[order])
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "probes": pa.array([int(n.sum())], pa.int64()), "blob": pa.array([index.dump()], pa.binary())})


def _probe(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard, the shard's arrays before its probes."""
        index = shard = None
        for batch in batches:
            shards, blobs = batch.column(0).to_numpy(), batch.column(1)
            columns = [np.asarray(batch.column(i).fill_null(0)) for i in range(2, 6)]
            arrays = np.flatnonzero(np.asarray(blobs.is_valid()))
            for a, b in zip([-1, *arrays], [*arrays, len(shards)], strict=True):
                if a >= 0:
                    index, shard = LineIndex.load(blobs[int(a)].as_py()), shards[a]
                if b == a + 1:
                    continue
                if index is None or (shards[a + 1 : b] != shard).any():
                    raise RuntimeError("probes came without the arrays of their shard")
                khi, klo, hi, lo = (x[a + 1 : b] for x in columns)
                hit = index.count(hi, lo) >= min_docs
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (khi, klo, hi, lo)], ["khi", "klo", "hi", "lo"])

    return run


def frequent_lines(docs: DataFrame, text_col: str, min_docs: int, min_chars: int) -> DataFrame:
    """(khi, klo, hi, lo): text digest and line hash, for lines that at least min_docs documents hold."""
    lines = cut(docs.select(text_of(text_col).cast("binary").alias("text")).mapInArrow(_lines(min_chars), LINES))
    counts = cut(lines.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")))
    shards = max(1, -(-counts.count() // KEYS_PER_SHARD))
    shard = F.pmod(F.col("hi"), F.lit(shards)).cast("long").alias("shard")
    index = cut(counts.select(shard, "hi", "lo", "n").groupBy("shard").applyInArrow(_build, "shard long, probes long, blob binary"))
    salts = index.select("shard", F.ceil(F.col("probes") / PROBES_PER_SALT).cast("long").alias("salts"))
    arrays = index.select("shard", F.explode(F.sequence(F.lit(0), F.ceil(F.col("probes") / PROBES_PER_SALT).cast("long") - 1)).alias("salt"), "blob", *(F.lit(None).cast("long").alias(c) for c in ("khi", "klo", "hi", "lo")))
    probes = lines.select(shard, "khi", "klo", "hi", "lo").join(salts, "shard")
    probes = probes.select("shard", F.pmod("klo", "salts").alias("salt"), F.lit(None).cast("binary").alias("blob"), "khi", "klo", "hi", "lo")
    dealt = arrays.unionByName(probes).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("blob").isNull())
    dealt = dealt.select("shard", "blob", "khi", "klo", "hi", "lo")
    return dealt.mapInArrow(_probe(min_docs), LINES)


def dedup_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with its lines of at least ``min_docs`` documents removed from ``text_col``.

    Lines end at \\n; a key is the line without ASCII white space at both ends and with A-Z
    lower-cased. Keys of at least ``min_chars`` code points lose all their lines everywhere, the
    other lines stay in order. Every row counts as a document, also one with a null or repeated id
    or a repeated text. A null or empty text is one empty line and gives an empty text. Adds
    ``n_lines`` (before) and ``n_dropped``, which replace columns of that name; all other columns
    stay. An empty table stays empty.
    """
    khi, klo, drop = (f"{OWN}{x}" for x in ("khi", "klo", "drop"))
    hits = frequent_lines(docs, text_col, min_docs, min_chars)
    drops = hits.groupBy("khi", "klo").agg(F.collect_set(F.struct("hi", "lo")).alias("drop"))
    drops = cut(drops.select(F.col("khi").alias(khi), F.col("klo").alias(klo), F.col("drop.hi").alias(f"{OWN}hi"), F.col("drop.lo").alias(f"{OWN}lo")))
    digest = F.md5(text_of(text_col).cast("binary"))

    def half(start: int):  # 64 bits of the digest as a signed long
        return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")

    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows, touched = docs.select(*keep).withColumns({khi: half(1), klo: half(17)}), Sieve.of(drops, khi)
    hit = touched.keep(rows, khi).join(drops, [khi, klo], "left").drop(khi, klo)  # a frequent text has many rows here but one there, so Spark can split it
    none = F.lit(None).cast("array<long>")
    rows = hit.unionByName(touched.keep(rows, khi, inside=False).drop(khi, klo).withColumns({f"{OWN}hi": none, f"{OWN}lo": none}))
    schema = docs.select(*keep).withColumn(text_col, F.lit("")).schema
    schema = schema.add("n_lines", "long").add("n_dropped", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            his, los = (batch.column(batch.schema.get_field_index(f"{OWN}{x}")).to_pylist() for x in ("hi", "lo"))
            kept, n_lines, n_dropped = [], [], []
            for text, hi, lo in zip(as_bytes(batch, text_col), his, los, strict=True):
                lines = (text or b"").split(b"\n")
                n_lines.append(len(lines))
                if hi:
                    gone = {np.array(x, ">i8").tobytes() for x in zip(hi, lo, strict=True)}
                    lines = [x for x in lines if code_points(k := line_key(x)) < min_chars or xxhash.xxh3_128_digest(k) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines))
            new = {text_col: pa.array(kept, pa.binary()).cast(pa.string())}
            columns = [new.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names[: len(keep)])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*keep, "n_lines", "n_dropped"])

    return rows.mapInArrow(run, schema)
