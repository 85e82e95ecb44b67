from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrane.functions import maths, strings, texts, words
from terrane.operators import entities, graphs, partition, translate
from terrane.sources import readers
from terrane.streaming import replicate


def one(spark, column, value="x"):
    return spark.createDataFrame([(value,)], "s string").select(column.alias("v")).first().v


S = lambda: F.col("s")


def test_word_vectors(spark):
    assert one(spark, words.word_find(S(), "||", "#"), "C:\\io.sys|||logo.sys|||WINDOWS") == "3"
    assert one(spark, words.word_find(S(), "||", "-2"), "||io.sys||||Program Files||||WINDOWS") == "Program Files"
    assert one(spark, words.word_replace(S(), "a", "b", "-1"), "a.a.a") == "a.a.b"
    assert one(spark, words.word_add(S(), " ", "b c"), "a b") == "a b c"
    assert one(spark, words.word_add(S(), " ", "b", remove=True), "a b c") == "a c"
    assert one(spark, words.word_insert(S(), " ", "new", 9), "a b") == "a b new"
    assert one(spark, words.between(S(), "<", ">", 2), "<a> <b>") == "b"
    assert one(spark, words.between_with(S(), "<", "x", ">"), "<a> <bx>") == "bx"
    assert one(spark, words.version_convert(S()), "1.2b") == "1.2.02"
    assert [one(spark, words.version_compare(S(), F.lit(v)), "1.10.0") for v in ("1.9", "1.10", "2")] == [1, 0, 2]


def test_string_vectors(spark):
    assert one(spark, strings.str_case(S(), "S"), "hELLO World") == "Hello world"
    assert one(spark, strings.str_case(S(), "<>"), "aB") == "Ab"
    assert one(spark, strings.str_str(S(), "zz"), "abc") is None and one(spark, strings.str_str(S(), "b"), "abc") == "bc"
    assert one(spark, strings.str_str_adv(S(), ".", keep=False), "a.b.c") == "b.c"
    assert one(spark, strings.str_str_adv(S(), ".", from_end=True, keep=False), "a.b.c") == "c"
    assert one(spark, strings.str_tok(S(), ",;", -1), "a,b;c;") == "c"
    assert one(spark, strings.trim_newlines(S()), "a\n\r\n") == "a"
    assert one(spark, strings.unescape(strings.escape(S())), "a\tb$n\r\n") == "a\tb$n\r\n"
    assert one(spark, texts.config_read(S(), "k="), "a=1\nK=2\nk=3") == "2"
    assert one(spark, texts.config_write(S(), "b=", "7"), "a=1") == "a=1\nb=7"
    assert one(spark, texts.option(S(), "/D="), "/S=a /d=c:\\x y /Q") == "c:\\x y"
    assert one(spark, texts.base_name(S()), "a/b.c.txt") == "b.c" and one(spark, texts.file_extension(S()), "a/b.c.txt") == "txt"
    m, e = maths.frexp(S().cast("double"))
    assert one(spark, F.struct(m.alias("m"), e.alias("e")), "-12") == (-0.75, 4)


def test_registry(spark):
    tasks = maths.Registry()
    tasks.register("keep", lambda df, n: df.where(F.col("id") < n))
    assert tasks.run(spark.range(9), [("keep", {"n": 5}), ("keep", {"n": 3})]).count() == 3
    with pytest.raises(KeyError):
        tasks.run(spark.range(1), [("nothing", {})])
    with pytest.raises(ValueError):
        tasks.register("keep", None)


def test_languages(spark):
    rows = spark.createDataFrame([(0, "a", "EN", "x")], "ord int, key string, lang string, text string")
    for bad in ({"add": "PL"}, {"add": "PL", "copy": "PL"}, {"add": "POL", "copy": "EN"}, {"add": "PL", "copy": "EN", "remove": "DE"}, {}):
        with pytest.raises(ValueError):
            translate.change_languages(rows, **bad)
    objects = spark.createDataFrame([("point", 1, 0), ("line", 2, 0)], "kind string, type int, subtype int")
    texts_ = spark.createDataFrame(readers.parse_symbols("[_point]\nType=0x01\nSubType=0x00\nString1=0x04,Hut\nString2=0x02,Hütte\n[end]"), "kind string, type int, subtype int, code string, text string")
    got = {r.kind: r.strings for r in translate.attach_strings(objects, texts_).collect()}
    assert got == {"point": {"0x02": "Hütte", "0x04": "Hut"}, "line": None}
    assert readers.parse_translations("#define $__HUT__ Hütte\n#define $__HUT__EN Hut")[1] == (1, "HUT", "EN", "Hut")


def test_changes_round_trip(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (4, None)], "id long, v string")
    change = entities.derive_change(old, new)
    assert {(r.id, r.action) for r in change.collect()} == {(1, "delete"), (2, "modify"), (4, "create")}
    assert sorted(map(tuple, entities.apply_change(old, change).collect())) == sorted(map(tuple, new.collect()))
    with pytest.raises(ValueError):
        entities.apply_change(old, change.union(change))


def test_graph(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 60), (70, 70)], "a long, b long")
    got = {r.node: r.island for r in graphs.islands(edges).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and got[60] == 50 and 70 not in got
    members = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "relation string, member string")
    found = graphs.descendants(members, spark.createDataFrame([("a",)], "id string")).collect()
    assert {(r.member, r.depth) for r in found} == {("b", 1), ("c", 2), ("d", 3)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 35), st.integers(0, 17), st.integers(1, 50)), min_size=1, max_size=40, unique_by=lambda c: c[:2]), st.integers(1, 120))
def test_split_tiles_do_not_overlap(cells, most):
    size = 100_000_000
    tiles = partition.split(cells, most, size)
    weights = [0] * len(tiles)
    for x, y, n in cells:
        px, py = partition.WORLD[0] + x * size, partition.WORLD[1] + y * size
        inside = [i for i, t in enumerate(tiles) if t[1] <= px < t[3] and t[2] <= py < t[4]]
        assert len(inside) == 1
        weights[inside[0]] += n
    assert all(w <= most or (t[3] - t[1] == size and t[4] - t[2] == size) for w, t in zip(weights, tiles))


def test_files(spark, tmp_path):
    xml = '<r><node id="1" version="2" lat="1.5" lon="-0.0000001"><tag k="a" v="b"/></node><node id="-2" lat="0" lon="1"/><way id="5"><nd ref="1"/><nd ref="-2"/></way></r>'
    (tmp_path / "e.xml").write_text(xml)
    nodes = readers.read_entity_xml(spark, str(tmp_path / "e.xml"), "node").orderBy("id").collect()
    assert [(n.id, n.lat_e7, n.lon_e7, n.tags) for n in nodes] == [(-2, 0, 10000000, {}), (1, 15000000, -1, {"a": "b"})]
    assert readers.read_entity_xml(spark, str(tmp_path / "e.xml"), "way").first().nodes == [1, -2]
    readers.write_node_xml(readers.read_entity_xml(spark, str(tmp_path / "e.xml"), "node"), str(tmp_path / "out"))
    assert readers.read_entity_xml(spark, str(tmp_path / "out"), "node").count() == 2
    name, rings = readers.parse_polygon("area\n1\n  1.0E+00\t2.0\n 3 4\n5 6\nEND\n2\n 0 0\n1 1\nEND\nEND")
    assert name == "area" and rings == [[(10000000, 20000000), (30000000, 40000000), (50000000, 60000000)], [(0, 0), (10000000, 10000000)]]
    areas = spark.createDataFrame([(63240001, 10, -5, 20, 7)], "tile_id long, left long, bottom long, right long, top long")
    readers.write_areas(areas, str(tmp_path / "areas"))
    assert readers.read_areas(spark, str(tmp_path / "areas")).select(areas.columns).collect() == areas.collect()
    (tmp_path / "problems").write_text("way:12 # note\nrel: 7\n# way:3\n")
    assert {tuple(r) for r in readers.read_problem_list(spark, str(tmp_path / "problems")).collect()} == {("way", 12), ("rel", 7)}
    rows = spark.createDataFrame([(1, None), (2, "x y")], "id long, v string")
    readers.write_copy(rows, str(tmp_path / "copy"))
    assert sorted(map(str, readers.read_copy(spark, str(tmp_path / "copy"), "id long, v string").collect())) == sorted(map(str, rows.collect()))


def test_store_ignores_stale_and_repeated_batches(spark, tmp_path):
    store = replicate.Store(spark, str(tmp_path / "store"), "id long, version int, ts timestamp_ntz, v string")
    schema, t = "id long, version int, action string, ts timestamp_ntz, v string", datetime(2024, 1, 1)
    store.apply(spark.createDataFrame([(1, 2, "create", t, "b"), (2, 1, "create", t, "x")], schema), 0)
    store.apply(spark.createDataFrame([(1, 1, "modify", t, "late"), (2, 2, "delete", t, None)], schema), 1)
    store.apply(spark.createDataFrame([(9, 1, "create", t, "again")], schema), 1)
    assert [(r.id, r.v) for r in store.read().collect()] == [(1, "b")]
