"""Literal vectors of the rule semantics: what a map shows for given tags."""

import pytest
from pyspark.sql import functions as F

from terrane.operators import composites, translate
from terrane.plans import rulesets
from terrane.plans.compile import apply_rules, as_speed
from terrane.plans.rules import parse_rules


def shown(spark, text, *entities, geometry=()):
    rows = [(i, tags, *more) for i, (tags, *more) in enumerate(entities)]
    frame = spark.createDataFrame(rows, "id long, tags map<string,string>" + "".join(f", {g} double" for g in geometry))
    out = {i: [] for i in range(len(entities))}
    for r in apply_rules(frame, parse_rules(text), geometry=geometry).orderBy("id", "ord").collect():
        out[r.id].append(r)
    return list(out.values())


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_huts_and_fuel(spark):
    words = {"ALPINEHUT": "Berghütte", "FUELSTATION": "Tankstelle"}
    named, bare, fuel = shown(spark, rulesets.huts_and_fuel(words), ({"tourism": "alpine_hut", "name": "A", "ele": "1200"},), ({"tourism": "alpine_hut"},), ({"amenity": "fuel", "operator": "X", "name": "Y"},))
    assert [(r.type, r.low, r.label) for r in named] == [(0x4803, 23, "A (1200)")]
    assert [(r.type, r.label) for r in bare] == [(0x4803, "Berghütte")]
    assert [(r.type, r.label) for r in fuel] == [(0x2F01, "X")]
    (english,) = shown(spark, rulesets.huts_and_fuel(words | {"ALPINEHUT": "Alpine hut"}), ({"tourism": "alpine_hut"},))
    assert english[0].label == "Alpine hut"


def test_places(spark):
    big, small = shown(spark, rulesets.places(), ({"place": "city", "population": "1200000"},), ({"place": "city"},))
    assert [(r.type, r.low) for r in big + small] == [(0x0100, 12), (0x0200, 14)]


def test_motorway(spark):
    looks = [(0x011F13, 24, 24), (0x010F0A, 22, 23), (0x010F0B, 20, 21), (0x010E0A, 14, 19)]
    plain, bridge, none = shown(spark, rulesets.roads(), *[({"highway": "motorway", "ref": "A1"} | b,) for b in ({}, {"bridge": "yes"}, {"bridge": "no"})])
    assert (plain[0].type, plain[0].road_class, plain[0].road_speed, plain[0].label) == (0x01, 4, 7, "A1")
    assert [(r.type, r.low, r.high) for r in plain[1:]] == looks
    assert (0x010409, 24, 24) in [(r.type, r.low, r.high) for r in bridge]
    assert 0x010409 not in [r.type for r in none]


def test_woods(spark):
    found = shown(spark, rulesets.landuse_areas(), ({"landuse": "forest", "leaf_type": "broadleaved"},), ({"natural": "wood"},), ({"landuse": "forrest"},))
    assert [r[0].type for r in found] == [0x15, 0x52, 0x52]


def test_power(spark):
    found = shown(spark, rulesets.power_areas(), ({"power": "generator"}, 200.0), ({"power": "generator"}, 150.0), geometry=("length",))
    assert [[(r.type, r.low) for r in x] for x in found] == [[(0x25, 22)], [(0x25, 24)]]


def test_references_become_labels(spark):
    (found,) = shown(spark, "highway = * [0x1]\n" + rulesets.labels(), ({"highway": "x", "ref": "A1;B2"},))
    assert found[0].labels == ["A1", "B2"]


@pytest.mark.parametrize("levels,known,city", [({4: "Hamburg"}, "X", "Hamburg"), ({8: "Gemeinde Spalt"}, None, "Spalt"), ({8: "Stadt Linz am Rhein"}, None, "Linz am Rhein"), ({6: "Bremen", 9: "Mitte"}, None, "Bremen"), ({8: "Y"}, "X", "X")])
def test_cities(spark, levels, known, city):
    none = F.lit(None).cast("string")
    columns = {k: F.lit(levels[k]) if k in levels else none for k in (4, 6, 8, 9, 10)}
    assert value(spark, composites.city_of(F.lit("DEU"), columns, F.lit(known) if known else none)) == city


@pytest.mark.parametrize("maxspeed,highway,cls", [("100", "primary", 5), ("100", "residential", 2), ("none", "motorway", 7), ("none", "primary", None), ("121", "trunk", 7), ("120", "trunk", 6), ("5", "track", 0), ("20", "track", None), ("90", "track", 4)])
def test_speed_classes(spark, maxspeed, highway, cls):
    assert value(spark, composites.highway_speed_class(as_speed(F.lit(maxspeed)), F.lit(maxspeed), F.lit(highway))) == cls


def test_general_speed_ladder(spark):
    ladder = {111: 7, 110: 6, 90: 5, 80: 4, 60: 3, 40: 2, 20: 1, 10: 0, 0: 0}
    assert {k: value(spark, composites.speed_class(F.lit(float(k)))) for k in ladder} == ladder
    assert value(spark, composites.speed_class(F.lit(None).cast("double"))) is None


def test_unpaved(spark):
    none = F.lit(None).cast("string")
    flag = lambda h, su=none, tr=none, sm=none, **more: value(spark, composites.unpaved(F.lit(h), su, tr, sm, **more))
    assert not flag("track", F.lit("asphalt"), none, F.lit("very_bad"))  # the pattern's words have blanks around them
    assert flag("track", F.lit("asphalt"), none, F.lit("so impassable"))
    assert flag("track") and not flag("service") and flag("service", F.lit("wood")) and flag("service", F.lit("asphalt"), F.lit("grade5"))
    assert flag("service", mtb_scale=F.lit("0")) and flag("service", sport=F.lit("via_ferrata"))


def test_access(spark):
    none, lit, inherit = F.lit(None).cast("string"), F.lit, composites.inherit_access
    access, vehicle, bicycle = lit("yes"), lit("no"), lit("yes")
    assert value(spark, inherit(none, none, vehicle, access)) == "no"
    assert value(spark, inherit(bicycle, vehicle, access)) == "yes"
    assert value(spark, inherit(none, access)) == "yes"
    assert [value(spark, inherit(lit(x))) for x in ("delivery", "psv", "residents", "customer", "odd")] == ["no", "no", "yes", "yes", "no"]
    assert value(spark, inherit(none, none)) == "yes" and value(spark, inherit(none, none, reserved=lit(True))) == "no"


def test_added_language_follows_each_row(spark):
    words = spark.createDataFrame([(0, "A", None, "a"), (1, "A", "EN", "e"), (2, "B", "EN", "f")], "ord int, key string, lang string, text string")
    got = sorted((r.key, r.lang or "", r.text) for r in translate.change_languages(words, add="PL", copy="EN").collect())
    assert got == [("A", "", "a"), ("A", "EN", "e"), ("A", "PL", "e"), ("B", "EN", "f"), ("B", "PL", "f")]


def test_contours(spark):
    c = lambda ext, ele, **more: value(spark, composites.contour_class(F.lit("elevation"), F.lit(ext), F.lit(ele), **more))
    assert [c("elevation_minor", "10"), c("elevation_major", "100"), c("elevation_medium", "0"), c("elevation_medium", "-5", extended=True), c("other", "5")] == ["minor", "major", None, "medium", None]
