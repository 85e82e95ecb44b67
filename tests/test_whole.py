"""Queries over whole tables and whole texts, against plain Python."""

import re

import pyarrow as pa
import pyarrow.parquet as pq

from terrane import queries
from terrane.operators import graphs


def lines(path, ways):
    rows = [(way, k, node) for way, nodes in ways.items() for k, node in enumerate(nodes)]
    columns = {"l_orderkey": [r[0] for r in rows], "l_linenumber": [r[1] for r in rows], "l_partkey": [r[2] for r in rows]}
    columns |= {c: [1] * len(rows) for c in ("l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")}
    pq.write_table(pa.table(columns), path / "lineitem.parquet")


def parts_of(ways):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for nodes in ways.values():
        for a, b in zip(nodes, nodes[1:]):
            if a != b:
                low, high = sorted((top(a), top(b)))
                up[high] = low
    return {x: top(x) for x in up}


def test_islands_of_all_ways(spark, tmp_path):
    ways = {40: [1, 2, 3], 80: [7, 8], 41: [3, 7], 42: [20, 21, 20], 43: [22, 21], 44: [30, 30, 31], 45: [50], 46: [60, 60]}
    ways |= {k: [k, k + 1] for k in range(100, 119)}
    lines(tmp_path, ways)
    got = {r.node: r.island for r in queries.QUERIES["islands"](spark, str(tmp_path)).collect()}
    assert got == parts_of(ways)
    assert got[8] == 1 and got[22] == 20 and got[119] == 100


def documents(path, texts):
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}), path / "documents.parquet")


TEXTS = [None, "", "é", "x" * 79 + "éßñ", "The é\nß ñ 日本 😀 " * 500 + "end ü", "The " + "a b\t\n c " * 900 + "All rights reserved.", "La to.", "The to.", "A x  of the.", "Der  \u2028y to.", "reserved.", "Of the to. ", "x of then", "x to.\n"]


def test_transliterate_whole_texts(spark, tmp_path):
    documents(tmp_path, TEXTS)
    got = {r.doc_id: r.ascii for r in queries.QUERIES["transliterate"](spark, str(tmp_path)).collect()}
    plain = lambda t: re.sub(r"[^\x00-\x7F]", "?", t.replace("é", "e").replace("ß", "ss").replace("ñ", "n"))
    assert got == {i: None if t is None else plain(t) for i, t in enumerate(TEXTS)}


def test_road_affix_split_whole_texts(spark, tmp_path):
    documents(tmp_path, TEXTS)
    got = {r.doc_id: (r.prefix, r.core, r.suffix) for r in queries.QUERIES["road_affix_split"](spark, str(tmp_path)).collect()}

    def split(text):
        core = re.sub(r"[\t\n\f\r ]+", " ", text)
        prefix = next((p for p in ("The", "La", "Der", "A") if core.startswith(p + " ")), "")
        core = core[len(prefix) + 1 :] if prefix else core
        suffix = next((x for x in ("of the.", "the.", "to.", "reserved.") if core.endswith(" " + x)), "")
        return prefix, core[: -len(suffix) - 1] if suffix else core, suffix

    assert got == {i: (None,) * 3 if t is None else split(t) for i, t in enumerate(TEXTS)}
    assert {x[2] for x in got.values()} == {None, "", "of the.", "to.", "reserved."}


def test_descendants_beyond_64_levels(spark):
    members = spark.createDataFrame([(i, i + 1) for i in range(67)], "relation long, member long").coalesce(1)
    found = graphs.descendants(members, spark.createDataFrame([(0,)], "id long")).collect()
    assert sorted((r.member, r.depth) for r in found) == [(i, i) for i in range(1, 68)]


def test_islands_with_ids_near_the_end_of_64_bits(spark):
    big = 4 * 10**18
    edges = spark.createDataFrame([(big, big + 1), (big + 1, big + 2), (big + 7, big + 8)], "a long, b long")
    assert {r.node: r.island for r in graphs.islands(edges).collect()} == {big: big, big + 1: big, big + 2: big, big + 7: big + 7, big + 8: big + 7}


def test_nearest_along_and_nearby_duplicates(spark):
    import random

    rng = random.Random(2)
    points = [(i, rng.choice("abc"), float(rng.randint(-50, 50))) for i in range(300)]
    places = [(i, rng.choice("abd"), float(rng.randint(-30, 30))) for i in range(40)] + [(99, "b", 500.0)]
    got = graphs.nearest_along(spark.createDataFrame(points, "id long, street string, x double"), spark.createDataFrame(places, "road long, street string, x double"), "street", "x", "road", cells=8)
    want = {i: min((abs(x - y), r) for r, t, y in places if t == s)[1] for i, s, x in points if any(t == s for _, t, _ in places)}
    assert {r.id: r.road for r in got.collect()} == want
    spots = [(i, rng.choice("xy") if i % 9 else None, rng.randint(0, 400), rng.randint(0, 400)) for i in range(400)]
    kept = graphs.nearby_duplicates(spark.createDataFrame(spots, "id long, kind string, lat_e7 long, lon_e7 long"), "kind", 25)
    alone = {i for i, k, a, o in spots if not any(k is not None and k == k2 and j < i and abs(a - b) <= 25 and abs(o - p) <= 25 for j, k2, b, p in spots)}
    assert {r.id for r in kept.collect()} == alone


def test_islands_with_a_hub_and_one_large_part(spark, monkeypatch):
    monkeypatch.setattr(graphs, "HOT", 8)
    monkeypatch.setattr(graphs, "HOT_ROWS", 5)
    chain = [(i, i + 1) for i in range(1000, 1200)]
    star = [(5000, 5001 + i) for i in range(400)] + [(5001, 1000)]
    edges = spark.createDataFrame(chain + star + [(9000, 9001)], "a long, b long")
    found = {r.node: r.island for r in graphs.islands(edges).collect()}
    assert found == {n: 9000 if n >= 9000 else 1000 for pair in chain + star + [(9000, 9001)] for n in pair}
