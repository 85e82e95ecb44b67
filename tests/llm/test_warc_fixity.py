import gzip
import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from terrane.llm import warc_fixity as wf
from terrane.llm._common import fresh_path

SCHEMA = "page_id long, url string, html string, status string"


def record(row):
    body = (row[2] or "").encode()
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if row[0] is None else row[0]}>\r\nWARC-Target-URI: {row[1] or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def digest(row):
    return hashlib.sha256(record(row)).hexdigest()


def brute(a, b):
    """Per key: digests that only one side has, paired in order."""
    out = []
    for key in {r[0] for r in a + b}:
        x, y = sorted(digest(r) for r in a if r[0] == key), sorted(digest(r) for r in b if r[0] == key)
        for d in list(x):
            if d in y:
                x.remove(d), y.remove(d)
        out += [(key, "altered")] * min(len(x), len(y)) + [(key, "missing")] * max(0, len(x) - len(y)) + [(key, "extra")] * max(0, len(y) - len(x))
    return sorted(out, key=str)


def written(spark, rows):
    return wf.write_warc(spark.createDataFrame(rows, SCHEMA), fresh_path(spark, "warc"), file_records=100)


def test_against_brute_force(spark):
    rng = random.Random(1)
    a = [(i, f"http://h/{i}", "é" * rng.randint(0, 50), "clash") for i in range(300)] + [(300, None, None, ""), (301, "u", "x" * 200_000, ""), (None, "n", "null id", ""), (7, "again", "same id", ""), (9, "http://h/9", a9 := "twin", ""), (9, "http://h/9", a9, "")]
    a += [(None, "n", f"null id {i % 40}", "") for i in range(150)]
    b = [r for r in a if r[0] not in (11, 12)][1:]
    b = [(i, u, (h or "") + "!", s) if i in (20, 150, 301) else (i, u, h, s) for i, u, h, s in b] + [(999, "new", "extra", ""), (9, "http://h/9", "twin", ""), (None, "n", "null id 3", "")]
    paths = [written(spark, x) for x in (a, b)]
    got = wf.locate_corruption(spark, *paths).collect()
    assert sorted(((int(r.key) if r.key else None, r.status) for r in got), key=str) == brute(a, b)
    held = [{(r.segment, r.offset): r for r in wf.read_warc(spark, p).collect()} for p in paths]
    for r in got:  # segment, offset and length are where the record stands
        spot = held[r.status == "extra"][r.segment, r.offset]
        assert (spot.key, spot.length) == (r.key, r.length)
    assert wf.locate_corruption(spark, paths[0], written(spark, a[::-1])).count() == 0
    none = written(spark, [])
    assert wf.locate_corruption(spark, none, none).count() == 0
    assert {r.status for r in wf.locate_corruption(spark, paths[0], none).collect()} == {"missing"}


def test_audit_descends_only_where_roots_differ(spark):
    index = spark.range(20_000).select(F.lit("s").alias("segment"), F.col("id").alias("offset"), F.lit(1).cast("long").alias("length"), F.col("id").cast("string").alias("key"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    depth = wf.depth_for(20_000)
    altered = index.where("key <> '5'").withColumn("digest", F.when(F.col("key") == "77", F.lit(b"0")).otherwise(F.col("digest")))
    trees = [wf.tree(x, depth) for x in (index, altered, index.repartition(3))]
    assert [t[0].count() for t in trees] == [1, 1, 1]
    assert trees[0][0].first() == trees[2][0].first() != trees[1][0].first()
    assert trees[0][0].first().records == 20_000
    found, compared = wf.audit(trees[0], trees[1])
    want = index.where("key in ('5', '77')").select(wf.leaf_of(F.col("key"), depth).alias("node")).distinct()
    assert {r.node for r in found.collect()} == {r.node for r in want.collect()}
    assert compared[0] == 1 and max(compared) <= 2 * wf.FANOUT and len(compared) == depth + 1
    found, compared = wf.audit(trees[0], trees[2])
    assert found.count() == 0 and compared == [1]
    assert sorted((r.key, r.status) for r in wf.compare(index, altered).collect()) == [("5", "missing"), ("77", "altered")]


def test_files(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}\n\r\n</p>\r\n\r\nWARC/1.0\r\n", "") for i in range(250)]
    path = written(spark, rows)
    from pathlib import Path

    files = [p for p in Path(path.removeprefix("file:")).iterdir() if p.suffix == ".gz"]
    data = [gzip.decompress(p.read_bytes()) for p in files]
    assert Counter(b"".join(data)) == Counter(b"".join(map(record, rows)))
    found = [(d[a : a + n], k) for d in data for a, n, k in wf.records_of(d)]
    assert sorted(found) == sorted((record(r), str(r[0])) for r in rows)
    broken = record(rows[0]).replace(b"Content-Length: ", b"Content-Length: 9") + record(rows[1])
    assert [k for _, _, k in wf.records_of(broken)][-1] == "1"
