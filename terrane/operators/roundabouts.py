"""Flares: two short roads that leave a roundabout side by side and meet again, which a map may draw as one.

Roads are followed from the roundabout on; where two of one roundabout meet first, lengths, bearings and angles are
columns, and so is what each threshold says of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The thresholds and their usual settings (metres, degrees, multiples, switches).
FLARE_RULES = {
    "max-flare-length": 200,
    "max-flare-length-multiple": 3,
    "max-flare-to-separation-multiple": 7,
    "flare-separation-override": 5,
    "max-flare-angle": 90,
    "max-flare-bearing": 90,
    "max-entry-angle": 145,
    "discard-both-flares-extend": True,
    "discard-multiple-flares": True,
    "discard-different-flare-names": True,
    "discard-different-accesses": True,
}


def flare_rules(text: str) -> dict:
    """Thresholds from ``name:value # comment`` lines over the usual ones; an unknown name is an error."""
    rules = dict(FLARE_RULES)
    for line in text.splitlines():
        name, _, value = (x.strip() for x in line.partition("#")[0].partition(":"))
        if not name:
            continue
        if name not in rules:
            raise ValueError(f"unknown flare rule {name}")
        rules[name] = value == "true" if isinstance(FLARE_RULES[name], bool) else float(value)
    return rules


def arm_steps(way_nodes: DataFrame, roundabouts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(roundabout, arm, pos, node, x, y) of every way from its end on a roundabout, and (roundabout, cx, cy).

    way_nodes: way_id, seq, node_id, x, y; roundabouts: way_id. A way with both ends on roundabouts is an arm of both. A way
    that only crosses one is none. A roundabout's centre is the mean of its distinct nodes.
    """
    rings = way_nodes.join(roundabouts.select("way_id"), "way_id", "left_semi").select(F.col("way_id").alias("roundabout"), "node_id", "x", "y").distinct()
    centres = rings.groupBy("roundabout").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    roads = way_nodes.join(roundabouts.select("way_id"), "way_id", "left_anti")
    ends = roads.groupBy("way_id").agg(F.min_by("node_id", "seq").alias("head"), F.max_by("node_id", "seq").alias("tail"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ends = ends.select("way_id", F.explode(F.array(F.struct(F.col("head").alias("node_id"), F.lit(1).alias("turn")), F.struct(F.col("tail").alias("node_id"), F.lit(-1).alias("turn")))).alias("e")).select("way_id", "e.*")
    starts = ends.join(rings.select("roundabout", "node_id"), "node_id").groupBy("roundabout", "way_id").agg(F.max("turn").alias("turn"))
    order = Window.partitionBy("roundabout", "way_id").orderBy(F.col("seq") * F.col("turn"))
    steps = roads.join(starts, "way_id").withColumn("pos", F.row_number().over(order))
    return steps.select("roundabout", F.col("way_id").alias("arm"), "pos", F.col("node_id").alias("node"), "x", "y"), centres


def _bearing(dx: Column, dy: Column) -> Column:
    return F.degrees(F.atan2(dy.cast("double"), dx.cast("double")))


def _between(a: Column, b: Column) -> Column:
    """The angle between two bearings, from 0 to 180, to six places."""
    return F.round(F.abs(F.pmod(a - b + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)), 6)


def flares(steps: DataFrame, centres: DataFrame, arms: DataFrame, rules: dict | None = None) -> DataFrame:
    """One row for each two neighbouring arms of a roundabout that meet: a < b, the node, the measures, what each rule says, ``flare``.

    steps, centres as of ``arm_steps``; arms: arm, name, access (null equals null). Arms at one node are ordered around the centre by
    the bearing of their first node; each is held against the next one only, and the last against the first. More than two there are multiple flares.
    Two arms that meet several times count where the way is shortest, ties at the smaller node. A node that an arm passes twice counts once.
    """
    r = FLARE_RULES | (rules or {})
    walk = Window.partitionBy("roundabout", "arm").orderBy("pos")
    s = steps.withColumns({"px": F.lag("x").over(walk), "py": F.lag("y").over(walk)})
    s = s.withColumn("part", F.coalesce(F.sqrt((F.col("x") - F.col("px")).cast("double") ** 2 + (F.col("y") - F.col("py")).cast("double") ** 2), F.lit(0.0)))
    s = s.withColumns({"length": F.sum("part").over(walk.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("pos").over(walk)})
    firsts = steps.where("pos <= 2").groupBy("roundabout", "arm").agg(*[F.max(F.when(F.col("pos") == p, F.col(c))).alias(f"{n}{c}") for p, n in ((1, "e"), (2, "f")) for c in ("x", "y")])
    met = s.where("pos > 1").groupBy("roundabout", "node", "arm").agg(F.min_by(F.struct("length", F.col("next").isNotNull().alias("extends"), "x", "y", "px", "py"), "pos").alias("m"))
    at = Window.partitionBy("roundabout", "node")
    met = met.withColumn("n", F.count(F.lit(1)).over(at)).where("n > 1")
    met = met.join(firsts, ["roundabout", "arm"]).join(centres, "roundabout").join(arms.select("arm", "name", "access"), "arm", "left")
    met = met.withColumn("around", F.round(_bearing(F.col("ex") - F.col("cx"), F.col("ey") - F.col("cy")), 6))
    me = F.struct("arm", "m", "ex", "ey", "fx", "fy", "around", "name", "access")
    ring = at.orderBy("around", "arm")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pairs = met.withColumn("me", me).withColumn("other", F.coalesce(F.lead("me").over(ring), F.first("me").over(whole)))
    pairs = pairs.withColumn("low", F.col("me.arm") < F.col("other.arm"))
    a, b = (F.when(F.col("low"), F.col(p)).otherwise(F.col(q)) for p, q in (("me", "other"), ("other", "me")))
    pairs = pairs.select("roundabout", "node", "n", a.alias("a"), b.alias("b")).withColumn("total", F.round(F.col("a.m.length") + F.col("b.m.length"), 6))
    best = pairs.groupBy("roundabout", F.col("a.arm").alias("arm_a"), F.col("b.arm").alias("arm_b")).agg(F.min_by(F.struct("node", "n", "a", "b"), F.struct("total", "node")).alias("p"))
    p = best.select("roundabout", "arm_a", "arm_b", "p.*")
    away = lambda c: _bearing(F.col(f"{c}.m.px") - F.col(f"{c}.m.x"), F.col(f"{c}.m.py") - F.col(f"{c}.m.y"))
    leaves = lambda c: _bearing(F.col(f"{c}.fx") - F.col(f"{c}.ex"), F.col(f"{c}.fy") - F.col(f"{c}.ey"))
    gap = F.sqrt((F.col("a.ex") - F.col("b.ex")).cast("double") ** 2 + (F.col("a.ey") - F.col("b.ey")).cast("double") ** 2)
    p = p.select(
        "roundabout", "arm_a", "arm_b", "node", "n", "a", "b",
        F.round("a.m.length", 6).alias("length_a"), F.round("b.m.length", 6).alias("length_b"), F.round(gap, 6).alias("separation"),
        _between(away("a"), away("b")).alias("angle"), _between(leaves("a"), leaves("b")).alias("bearing"), _between(F.col("a.around"), F.col("b.around")).alias("entry_angle"),
    )
    longer, shorter = F.greatest("length_a", "length_b"), F.least("length_a", "length_b")
    off = lambda name, bad: ~bad if r[name] else F.lit(True)
    says = {
        "ok_length": longer <= r["max-flare-length"],
        "ok_multiple": longer <= shorter * r["max-flare-length-multiple"],
        "ok_separation": longer <= F.greatest(F.col("separation"), F.lit(float(r["flare-separation-override"]))) * r["max-flare-to-separation-multiple"],
        "ok_angle": F.col("angle") <= r["max-flare-angle"],
        "ok_bearing": F.col("bearing") <= r["max-flare-bearing"],
        "ok_entry": F.col("entry_angle") <= r["max-entry-angle"],
        "ok_extend": off("discard-both-flares-extend", F.col("a.m.extends") & F.col("b.m.extends")),
        "ok_single": off("discard-multiple-flares", F.col("n") > 2),
        "ok_name": off("discard-different-flare-names", ~F.col("a.name").eqNullSafe(F.col("b.name"))),
        "ok_access": off("discard-different-accesses", ~F.col("a.access").eqNullSafe(F.col("b.access"))),
    }
    out = p.withColumns(says).drop("a", "b", "n")
    flare = F.lit(True)
    for name in says:
        flare = flare & F.col(name)
    return out.withColumn("flare", flare)
