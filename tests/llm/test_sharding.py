import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from terrane.llm.sharding import Leaf, place, shard_documents, topology
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, shard string, slot int"


def brute(key, tree):
    """The same descent, row by row."""
    k = f"k:{chr(0) if key is None else key}".encode()

    def pick(level, children):
        def draw(n):
            h = xxhash.xxh64(f"{level}:{n}".encode(), seed=xxhash.xxh64(k, seed=42).intdigest()).intdigest() >> 11
            return -math.log((h + 0.5) / 2**53) / children[n], n

        return min(map(draw, children))[1]

    regions, racks, shards = Counter(), defaultdict(Counter), defaultdict(dict)
    for x in tree:
        regions[x.region] += x.weight
        racks[x.region][x.rack] += x.weight
        shards[x.rack][x.shard] = x.weight
    return pick("shard", shards[pick("rack", racks[pick("region", regions)])])


def test_against_brute_force_and_growth(spark):
    rows = [(i, f"text {i % 7}" if i % 5 else None, "x", 1) for i in range(2000)] + [(None, "", None, None), (3, "again", None, None)]
    got = shard_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.shard == brute(r.doc_id, topology(40)) and r.grown_shard == brute(r.doc_id, topology(41))
        assert r.grown_shard in (r.shard, 40) and r.law == "key"
    assert any(r.grown_shard == 40 for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _, _ in rows)
    assert sorted((r["size"], r.text_crc32) for r in got) == want


def test_weights_confine_movement(spark):
    ids = spark.range(5000).withColumn("out", F.lit("clash"))
    tree = topology(40)
    heavier = [x._replace(weight=3.0) if x.shard == 0 else x for x in tree]
    a = {r.id: r.s for r in place(ids, F.col("id"), tree, "s").collect()}
    b = {r.id: r.s for r in place(ids, F.col("id"), heavier, "s").collect()}
    moved = {(a[i], b[i]) for i in a if a[i] != b[i]}
    region = {x.shard: x.region for x in tree}
    assert moved and all(region[y] == region[0] for _, y in moved)  # rows move only into the changed region
    counts = Counter(b.values())
    assert counts[0] > 1.8 * (sum(counts.values()) - counts[0]) / 39


def test_degenerate_inputs(spark):
    assert shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    one = place(spark.range(3), F.col("id"), [Leaf(0, 0, 5), Leaf(0, 0, 6, 0.0)], "s").collect()
    assert {r.s for r in one} == {5}
    assert [x.shard for x in topology(8, base=8)] == list(range(8))


@pytest.mark.parametrize("n,base", [(8, 8), (11, 8), (40, 40), (60, 40)])
def test_growth_moves_rows_only_into_the_new_shard(spark, n, base):
    ids = place(place(spark.range(4000), F.col("id"), topology(n, base), "a"), F.col("id"), topology(n + 1, base), "b")
    moved = {r.b for r in ids.where("a <> b").select("b").distinct().collect()}
    assert moved == {n}


def test_fewer_shards_than_the_base_are_refused():
    with pytest.raises(ValueError):
        topology(39)


def test_equal_rows_and_very_long_texts(spark):
    rows = [(5, "same", "", 0)] * 700 + [(5, "é" * 500_000, "", 0)]
    got = shard_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.slot for r in got) == list(range(701)) and max(r["size"] for r in got) == 1_000_016
