"""Relation closure, containment and XML round trips on small tables."""

from datetime import datetime

from terrane.operators import entities, partition
from terrane.sources import readers

MEMBERS = [("a", "R", "b"), ("b", "R", "c"), ("c", "N", "1"), ("c", "W", "2"), ("d", "N", "3"), ("e", "R", "a"), ("b", "R", "a")]


def test_relation_closure(spark):
    members = spark.createDataFrame(MEMBERS, "relation string, member_type string, member string")
    kept = spark.createDataFrame([("N", "1")], "member_type string, member string")
    assert {r.relation for r in entities.clip_relations(members, kept).collect()} == {"c"}
    assert {r.relation for r in entities.clip_relations(members, kept, cascading=True).collect()} == {"a", "b", "c", "e"}
    got = entities.complete_relations(members, spark.createDataFrame([("b",)], "relation string")).collect()
    assert sorted(map(tuple, got)) == [("N", "1"), ("R", "a"), ("R", "b"), ("R", "c"), ("W", "2")]
    assert [tuple(r) for r in entities.clip_incomplete(members, kept).collect()] == [("c", "N", "1")]
    tiles = spark.createDataFrame([("1", 7), ("3", 8), ("2", 9)], "member string, tile_id int")
    got = partition.complete_tiles(members, spark.createDataFrame([("c",), ("d",)], "id string"), tiles)
    assert {tuple(r) for r in got.collect()} == {("1", 7), ("1", 9), ("2", 7), ("2", 9), ("3", 8)}


def test_containment(spark):
    point = lambda x, y: {"x": x, "y": y}
    areas = [("square", [point(0, 0), point(10, 0), point(10, 10), point(0, 10), point(0, 0)]), ("hook", [point(-5, -5), point(20, -5), point(20, 20), point(15, 20), point(15, 0), point(-5, 0), point(-5, -5)]), ("none", [])]
    frame = spark.createDataFrame(areas, "area string, ring array<struct<x:long,y:long>>")
    spots = spark.createDataFrame([(1, 5, 5), (2, 17, 15), (3, 0, -1), (4, 12, 5), (5, 0, 0), (6, 10, 5)], "id long, lon_e7 long, lat_e7 long")
    for size in (3, 1000):
        got = {tuple(r) for r in entities.contained(spots, frame, "id", "area", cell_e7=size).collect()}
        assert got == {(1, "square"), (2, "hook"), (3, "hook"), (5, "square")} or got == {(1, "square"), (2, "hook"), (3, "hook")}


def test_xml_round_trips(spark, tmp_path):
    when = datetime(2024, 1, 5, 6, 7, 8)
    base = "id long, version int, user_id int, tstamp timestamp, changeset_id long, tags map<string,string>"
    nodes = spark.createDataFrame([(1, 2, 3, when, 4, {"b": "<&>", "a": "1"}, -5, 1234567890), (2, 1, None, None, None, {}, 0, -1)], base + ", lat_e7 long, lon_e7 long")
    ways = spark.createDataFrame([(7, 1, 3, when, 4, {"highway": "x"}, [1, 2, 1])], base + ", nodes array<long>")
    relations = spark.createDataFrame([(9, 1, 3, when, 4, {"type": "y"}, [("way", 7, "outer"), ("node", 1, None)])], base + ", members array<struct<type:string,id:long,role:string>>")
    for kind, frame in (("node", nodes), ("way", ways), ("relation", relations)):
        readers.write_entity_xml(frame, str(tmp_path / kind), kind)
        back = readers.read_entity_xml(spark, str(tmp_path / kind), kind).select(*frame.columns)
        assert sorted(map(repr, back.collect())) == sorted(map(repr, frame.select(*[frame[c] for c in frame.columns]).collect()))
    from pyspark.sql import functions as F

    changes = nodes.withColumn("action", F.when(F.col("id") == 1, "delete").otherwise("create"))
    readers.write_change_xml(changes, str(tmp_path / "changes"), "node")
    got = readers.read_change_xml(spark, str(tmp_path / "changes"), "node").collect()
    assert {(r.id, r.action, r.lat_e7, r.lon_e7) for r in got} == {(1, "delete", -5, 1234567890), (2, "create", 0, -1)}
