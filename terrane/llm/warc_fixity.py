"""Fixity audit of replicas of WARC files by Merkle trees.

Files hold their records in order of a key's hash, so that the records below a node of the tree
are one range of offsets in each file. A leaf covers one range of key hashes: it hashes the digests
and lengths of its records. A node hashes its up to ``FANOUT`` children in order, with their bytes
and records. A leaf's range is fixed by the key alone, so a record that is altered, lost or added
changes one path, wherever it stands and whatever stands before it.

Each tree is made once, level by level, each level from the one below. Replicas compare their
roots; only below a node that differs do they compare its children, and only the records of leaves
that differ are compared by digest.

A leaf is an order-free sum (exclusive or of digests of distinct records with their number of
copies), so a key that a third of all records share is summed before it is sent anywhere.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.llm._common import cut, stored

DIGIT = 4
FANOUT = 1 << DIGIT
#: Records a leaf, about, at most.
LEAF_RECORDS = 16
FILE_RECORDS = 4096
#: Parts in which the rows of one key are numbered.
PARTS = 64
CRLF = "\r\n"
INDEX = "segment string, offset long, length long, key string, digest binary"


def warc_record(uri: Column, payload: Column, record_id: Column) -> Column:
    """One WARC/1.0 resource record as text: headers, an empty line, the payload, two line ends."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(f">{CRLF}WARC-Target-URI: "), F.coalesce(uri, F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "), F.octet_length(body).cast("string"), F.lit(CRLF + CRLF), body, F.lit(CRLF + CRLF),
    )


def write_warc(records: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", file_records: int = FILE_RECORDS) -> str:
    """Records as gzipped WARC files of at most ``file_records`` records, in order of the key's hash within a partition.

    Null texts count as empty, a null key as no name; an empty table gives no record.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = records.select(F.xxhash64(name).alias("h"), warc_record(F.col(uri), F.col(payload), F.col(key)).alias("r"))
    ordered = rows.sortWithinPartitions("h").select(F.expr("substring(r, 1, length(r) - 4)").alias("value"))  # the line end closes it
    ordered.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)
    return path


HEAD = re.compile(rb"WARC/1\.0\r\n(.*?)\r\n\r\n", re.DOTALL)
NAME = re.compile(rb"WARC-Record-ID: <urn:page:(.*?)>\r")
LENGTH = re.compile(rb"Content-Length: (\d+)\Z")
NEXT = b"\r\n\r\nWARC/1.0\r\n"


#: Bytes of a damaged file that are inflated at a time.
PIECE = 1 << 16


def records_of(data: bytes) -> Iterator[tuple[int, int, str]]:
    """Offset, length and key of each record of a WARC file; bytes that are no record go up to where the next one begins."""
    at = 0
    while at < len(data):
        head = HEAD.match(data, at)
        size, name = (x.search(head[0][:-4]) for x in (LENGTH, NAME)) if head else (None, None)
        end = head.end() + int(size[1]) + 4 if size and name else -1
        if end < 0 or end > len(data) or data[end - 4 : end] != b"\r\n\r\n":
            following = data.find(NEXT, at)
            end = len(data) if following < 0 else following + 4
        yield at, end - at, name[1].decode("utf-8", "replace") if name else ""
        at = end


def inflated(content: bytes) -> bytes:
    """The bytes of a gzip file; of a damaged or cut one those that come before its fault, with what its bits now say."""
    try:
        return gzip.decompress(content)
    except (OSError, EOFError, zlib.error):
        out, inflate = [], zlib.decompressobj(31)
    for a in range(0, len(content), PIECE):
        piece = content[a : a + PIECE]
        while piece:
            before = inflate.copy()
            try:
                out.append(inflate.decompress(piece))
            except zlib.error:  # byte by byte, so that nothing before the fault is lost
                with suppress(zlib.error):
                    for i in range(len(piece)):
                        out.append(before.decompress(piece[i : i + 1]))
                return b"".join(out)
            piece = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
    return b"".join(out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data, place = inflated(content.as_py()), re.search(r"part-(\d+)-.*-c(\d+)", path)
            found = [(a, n, key, hashlib.sha256(data[a : a + n]).digest()) for a, n, key in records_of(data)]
            offsets, lengths, keys, digests = zip(*found, strict=True) if found else ((), (), (), ())
            segment = [f"{place[1]}-{place[2]}"] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(segment, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(keys, pa.string()), pa.array(digests, pa.binary())], [x.split()[0] for x in INDEX.split(", ")])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """segment (file), offset, length, key and SHA-256 digest of every record of the WARC files in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.gz").load(path)
    return files.select("path", "content").mapInArrow(_read, INDEX)


def depth_for(records: int) -> int:
    """Levels below the root so that a leaf holds some LEAF_RECORDS records at most."""
    depth = 1
    while FANOUT**depth * LEAF_RECORDS < records and depth < 15:
        depth += 1
    return depth


def leaf_of(key: Column, depth: int) -> Column:
    """The leaf that covers a key: the first digits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - DIGIT * depth)


def tree(index: DataFrame, depth: int) -> list[DataFrame]:
    """The levels of an index's tree, from the root to the leaves: node, records, bytes, hash."""
    distinct = index.groupBy("key", "digest", "length").agg(F.count(F.lit(1)).alias("copies"))
    record = F.sha2(F.concat(F.col("digest"), F.encode(F.concat_ws(":", "key", "length", "copies"), "utf-8")), 256)
    words = [F.conv(F.substring(record, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(4)]
    sums = [F.bit_xor(w).alias(f"x{i}") for i, w in enumerate(words)]
    leaves = distinct.groupBy(leaf_of(F.col("key"), depth).alias("node")).agg(F.sum("copies").alias("records"), F.sum(F.col("length") * F.col("copies")).alias("bytes"), *sums)
    leaves = leaves.select("node", "records", "bytes", F.unhex(F.sha2(F.encode(F.concat_ws(":", F.lit("leaf"), "records", "bytes", "x0", "x1", "x2", "x3"), "utf-8"), 256)).alias("hash"))
    levels = [stored(leaves, "warc-level")]
    for _ in range(depth):
        children = F.array_sort(F.collect_list(F.struct(F.col("node").alias("child"), "records", "bytes", "hash")))  # at most FANOUT
        text = F.array_join(F.transform(children, lambda x: F.concat_ws(":", x["child"], x["records"], x["bytes"], F.hex(x["hash"]))), ",")
        up = levels[0].groupBy(F.shiftrightunsigned("node", DIGIT).alias("node"))
        up = up.agg(F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.unhex(F.sha2(text, 256)).alias("hash"))
        levels.insert(0, stored(up, "warc-level"))
    return levels


def audit(a: list[DataFrame], b: list[DataFrame]) -> tuple[DataFrame, list[int]]:
    """Leaves (node) under which two trees differ, and how many nodes were compared on each level, from the root down.

    Equal trees, and two empty ones, give no leaves.
    """
    suspects, compared = None, []
    for x, y in zip(a, b, strict=True):
        if suspects is not None:
            first = F.shiftleft("node", DIGIT)
            below = suspects.select(F.explode(F.sequence(first, first + (FANOUT - 1))).alias("node"))
            x, y = x.join(below, "node", "left_semi"), y.join(below, "node", "left_semi")
        met = cut(x.select("node", F.col("hash").alias("ha")).join(y.select("node", F.col("hash").alias("hb")), "node", "full"))
        compared.append(met.count())
        suspects = met.where(~F.col("ha").eqNullSafe(F.col("hb"))).select("node")
        if not suspects.take(1):
            break
    return suspects, compared


def numbered(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: numbers from 1 within each group ``by``. A group is numbered in PARTS parts, so that no task holds it."""
    rows = df.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(PARTS)).cast("int"))
    sizes = rows.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*by, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy(*by, "part").orderBy(*order))
    return rows.withColumn("inside", inside).join(bases, [*by, "part"]).withColumn(name, F.col("base") + F.col("inside")).drop("part", "inside", "base")


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """key, segment, offset, length, status of every record in which two indexes differ, of the leaves that the audit finds."""
    depth = depth_for(a.count())
    found, _ = audit(tree(a, depth), tree(b, depth))
    only = []
    suspects = [cut(x.join(found, leaf_of(F.col("key"), depth) == F.col("node"), "left_semi")) for x in (a, b)]
    for mine, other in (suspects, suspects[::-1]):
        there = other.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("there"))
        copies = numbered(mine, ["key", "digest"], ["segment", "offset"], "nth").join(there, ["key", "digest"], "left")
        only.append(numbered(copies.where("there is null or nth > there"), ["key"], ["digest", "segment", "offset"], "pair"))
    x, y = only
    both = x.alias("a").join(y.alias("b"), [F.col("a.key") == F.col("b.key"), F.col("a.pair") == F.col("b.pair")], "full")
    status = F.when(F.col("b.key").isNull(), "missing").when(F.col("a.key").isNull(), "extra").otherwise("altered")
    return both.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in ("key", "segment", "offset", "length")], status.alias("status"))


def locate_corruption(spark: SparkSession, replica_a: str, replica_b: str) -> DataFrame:
    """key, segment, offset, length, status of every record in which two folders of WARC files differ.

    status is altered (the same key, another record), missing (only in a) or extra (only in b);
    segment and offset are of a, of extra ones of b. Repeated keys are told apart by digest, those
    with unlike digests pair in any order; equal records count by their number of copies. Records
    without a key share the empty one. Two empty folders differ in nothing; against an empty one all
    records are missing or extra. A damaged or cut gzip file counts as far as it can be inflated: the record at its fault is altered,
    extra or missing, and those behind it are missing.
    """
    a, b = (stored(read_warc(spark, path), "warc-index") for path in (replica_a, replica_b))
    return compare(a, b)
