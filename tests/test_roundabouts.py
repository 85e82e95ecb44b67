"""Flares of a roundabout built by hand, one threshold broken at a time."""

import pytest

from terrane.operators import roundabouts

RING = [(1, 0, 10), (2, 10, 0), (3, 0, -10), (4, -10, 0)]  # node, x, y
MEET = (50, 40, 0)


def found(spark, roads, names=None, accesses=None, rules=None):
    """roads: way -> nodes (node, x, y) from the roundabout on."""
    nodes = [(900, i, *n) for i, n in enumerate([*RING, RING[0]])] + [(w, i, *n) for w, ns in roads.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(nodes, "way_id long, seq int, node_id long, x long, y long").coalesce(2)
    steps, centres = roundabouts.arm_steps(df, spark.createDataFrame([(900,)], "way_id long"))
    assert [tuple(r) for r in centres.collect()] == [(900, 0.0, 0.0)]
    arms = spark.createDataFrame([(w, (names or {}).get(w, "High Street"), (accesses or {}).get(w)) for w in roads], "arm long, name string, access string")
    return {(r.arm_a, r.arm_b): r for r in roundabouts.flares(steps, centres, arms, rules).collect()}


FAIR = {11: [RING[0], (20, 20, 10), MEET], 12: [RING[1], (21, 25, 2), MEET]}
OK = [f"ok_{x}" for x in ("length", "multiple", "separation", "angle", "bearing", "entry", "extend", "single", "name", "access")]


def test_a_fair_pair_whatever_the_direction_of_its_roads(spark):
    for roads in (FAIR, {11: FAIR[11][::-1], 12: FAIR[12]}):
        (row,) = found(spark, roads).values()
        assert row.flare and all(row[c] for c in OK) and row.node == 50
        assert (row.length_a, row.separation, row.entry_angle) == (pytest.approx(20 + 500**0.5), pytest.approx(200**0.5), pytest.approx(90))


def test_each_threshold_alone(spark):
    tails = {w: [*ns, (60 + w, 80, w)] for w, ns in FAIR.items()}
    third = FAIR | {13: [RING[2], (22, 20, -10), MEET]}
    for name, got in {
        "ok_length": found(spark, FAIR, rules={"max-flare-length": 40}),
        "ok_multiple": found(spark, FAIR, rules={"max-flare-length-multiple": 1.1}),
        "ok_separation": found(spark, FAIR, rules={"max-flare-to-separation-multiple": 2}),
        "ok_angle": found(spark, FAIR, rules={"max-flare-angle": 10}),
        "ok_bearing": found(spark, FAIR, rules={"max-flare-bearing": 5}),
        "ok_entry": found(spark, FAIR, rules={"max-entry-angle": 89}),
        "ok_extend": found(spark, tails),
        "ok_single": found(spark, third),
        "ok_name": found(spark, FAIR, names={12: None}),
        "ok_access": found(spark, FAIR, accesses={12: "no"}),
    }.items():
        row = got[11, 12]
        assert not row.flare and [c for c in OK if not row[c]] == [name], name
    assert found(spark, tails, rules={"discard-both-flares-extend": False})[11, 12].flare
    assert found(spark, FAIR, rules={"max-flare-to-separation-multiple": 2, "flare-separation-override": 30})[11, 12].flare
    assert set(found(spark, third)) == {(11, 12), (12, 13), (11, 13)}


def test_roads_that_do_not_meet_and_rules_from_text(spark):
    assert found(spark, {11: [RING[0], (70, 0, 90)], 12: [RING[1], (71, 90, 0)]}) == {}
    rules = roundabouts.flare_rules("# all\nmax-flare-length:120 # metres\n\ndiscard-multiple-flares:false\n")
    assert rules == roundabouts.FLARE_RULES | {"max-flare-length": 120.0, "discard-multiple-flares": False}
    with pytest.raises(ValueError):
        roundabouts.flare_rules("max-flare-width:3")
