"""Lines and polygons cut on the borders of tiles, with border points that neighbouring tiles share exactly.

A border point lies on its border and is the exact crossing in the other coordinate, rounded half up. It depends on the
edge and the border only, so both tiles have the same one, whichever way the edge runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.operators.partition import WORLD

POINT = "struct<x: long, y: long>"


def _rounded(n: Column, d: Column) -> Column:
    """n / d (d > 0) rounded half up, in whole numbers."""
    rest = F.pmod(n, d)
    floor = F.call_function("div", n - rest, d)
    return floor + F.when(2 * rest >= d, 1).otherwise(0)


def _cells(df: DataFrame, cell_e7: int, left: str, bottom: str, right: str, top: str) -> DataFrame:
    """A row for each grid cell that a box meets, with the box's first cell."""
    at = lambda c, low: F.floor((F.col(c) - low) / cell_e7).cast("int")
    out = df.withColumns({"fx": at(left, WORLD[0]), "fy": at(bottom, WORLD[1])})
    return out.withColumn("cx", F.explode(F.sequence("fx", at(right, WORLD[0])))).withColumn("cy", F.explode(F.sequence("fy", at(top, WORLD[1]))))


def _meeting(boxes: DataFrame, areas: DataFrame, cell_e7: int) -> DataFrame:
    """Each box (x_lo, y_lo, x_hi, y_hi) with each tile (tile_id, l, b, r, t) that it meets, once: in the first cell that both are in.

    Tiles come from a split on the driver and are sent to all executors: boxes stay where they are, however many share the few cells of a coarse grid.
    """
    tiles = areas.select("tile_id", F.col("left").alias("l"), F.col("bottom").alias("b"), F.col("right").alias("r"), F.col("top").alias("t"))
    tiles = _cells(tiles, cell_e7, "l", "b", "r", "t").withColumnsRenamed({"fx": "tx", "fy": "ty"})
    met = _cells(boxes, cell_e7, "x_lo", "y_lo", "x_hi", "y_hi").join(F.broadcast(tiles), ["cx", "cy"])
    first = (F.col("cx") == F.greatest("fx", "tx")) & (F.col("cy") == F.greatest("fy", "ty"))
    return met.where(first & F.expr("x_lo <= r AND x_hi >= l AND y_lo <= t AND y_hi >= b")).drop("cx", "cy", "fx", "fy", "tx", "ty")


def segments(points: DataFrame, id_col: str = "way_id") -> DataFrame:
    """id, seq, x1, y1, x2, y2 of every piece of a line between points that follow each other; equal points give none."""
    order = Window.partitionBy(id_col).orderBy("seq")
    ahead = points.select(id_col, "seq", F.col("lon_e7").alias("x1"), F.col("lat_e7").alias("y1"), F.lead("lon_e7").over(order).alias("x2"), F.lead("lat_e7").over(order).alias("y2"))
    return ahead.where("x2 IS NOT NULL AND y2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)")


def cut_segments(parts: DataFrame, areas: DataFrame, cell_e7: int) -> DataFrame:
    """The columns of ``parts`` (x1, y1, x2, y2 among them) and tile_id, each part cut to every tile that it has a stretch in.

    By entering and leaving fractions of the four borders (Liang-Barsky), which are compared as whole numbers. A stretch along a border
    is in the tile to the right of it or above it. Coordinates are whole 1e-7 degrees.
    """
    boxed = parts.withColumns({"x_lo": F.least("x1", "x2"), "x_hi": F.greatest("x1", "x2"), "y_lo": F.least("y1", "y2"), "y_hi": F.greatest("y1", "y2")})
    met = _meeting(boxed, areas, cell_e7)
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def side(at: str, delta: Column, low: str, high: str) -> tuple[Column, Column, Column, Column]:
        """Borders that the line enters and leaves by, and the fractions of it that are before them, over its extent."""
        enter, leave = F.when(delta > 0, F.col(low)).otherwise(F.col(high)), F.when(delta > 0, F.col(high)).otherwise(F.col(low))
        sign = F.when(delta > 0, 1).otherwise(-1)
        return enter, leave, (enter - F.col(at)) * sign, (leave - F.col(at)) * sign

    ex, lx, nx_in, nx_out = side("x1", dx, "l", "r")
    ey, ly, ny_in, ny_out = side("y1", dy, "b", "t")
    met = _apart(met, {"dx": dx, "dy": dy, "ax": F.abs(dx), "ay": F.abs(dy), "ex": ex, "lx": lx, "ey": ey, "ly": ly, "nxi": nx_in, "nxo": nx_out, "nyi": ny_in, "nyo": ny_out})
    along = "(dx <> 0 OR (x1 >= l AND x1 < r)) AND (dy <> 0 OR (y1 >= b AND y1 < t))"
    # in: the later of 0 and both entries; out: the sooner of 1 and both exits; kinds: 0 an end, 1 a vertical border, 2 a level one.
    first = F.expr("CASE WHEN dx <> 0 AND nxi > 0 AND (dy = 0 OR nyi <= 0 OR nxi * ay >= nyi * ax) THEN 1 WHEN dy <> 0 AND nyi > 0 THEN 2 ELSE 0 END")
    last = F.expr("CASE WHEN dx <> 0 AND nxo < ax AND (dy = 0 OR nyo >= ay OR nxo * ay <= nyo * ax) THEN 1 WHEN dy <> 0 AND nyo < ay THEN 2 ELSE 0 END")
    met = _apart(met.where(along), {"first": first, "last": last})
    fraction = lambda kind, x, y, end: F.expr(f"CASE {kind} WHEN 1 THEN {x} WHEN 2 THEN {y} ELSE {end} END")
    met = _apart(met, {"n1": fraction("first", "nxi", "nyi", "0"), "d1": fraction("first", "ax", "ay", "1"), "n2": fraction("last", "nxo", "nyo", "1"), "d2": fraction("last", "ax", "ay", "1")})
    met = met.where("n1 * d2 < n2 * d1 AND n1 < d1 AND n2 > 0")

    def point(kind: str, n: str, border_x: str, border_y: str, end: int) -> tuple[Column, Column]:
        k, m = F.col(kind), F.col(n)
        x = F.when(k == 1, F.col(border_x)).when(k == 2, F.col("x1") + _rounded(m * F.col("dx"), F.greatest("ay", F.lit(1)))).otherwise(F.col(f"x{end}"))
        y = F.when(k == 2, F.col(border_y)).when(k == 1, F.col("y1") + _rounded(m * F.col("dy"), F.greatest("ax", F.lit(1)))).otherwise(F.col(f"y{end}"))
        return x, y

    (xa, ya), (xb, yb) = point("first", "n1", "ex", "ey", 1), point("last", "n2", "lx", "ly", 2)
    kept = [c for c in parts.columns if c not in ("x1", "y1", "x2", "y2")]
    return met.select(*kept, "tile_id", xa.alias("x1"), ya.alias("y1"), xb.alias("x2"), yb.alias("y2"))


def cut_lines(points: DataFrame, areas: DataFrame, cell_e7: int, id_col: str = "way_id") -> DataFrame:
    """id, tile_id, piece (from 0 in order) and points of every connected piece of a line (id, seq, lon_e7, lat_e7) in a tile."""
    cut = cut_segments(segments(points, id_col), areas, cell_e7)
    order = Window.partitionBy(id_col, "tile_id").orderBy("seq")
    fresh = (F.lag("seq").over(order).isNull()) | (F.lag("x2").over(order) != F.col("x1")) | (F.lag("y2").over(order) != F.col("y1"))
    numbered = cut.withColumn("fresh", fresh.cast("int")).withColumn("piece", F.sum("fresh").over(order) - 1)
    ends = F.struct("seq", F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")).alias("a"), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")).alias("b"))
    parts = numbered.groupBy(id_col, "tile_id", "piece").agg(F.sort_array(F.collect_list(ends)).alias("s"))
    return parts.select(id_col, "tile_id", "piece", F.concat(F.transform("s", lambda s: s["a"]), F.array(F.element_at("s", -1)["b"])).alias("points"))


def _crossing(p: Column, q: Column, axis: str, border: Column) -> Column:
    """The point where p to q meets a border of one coordinate."""
    other = "y" if axis == "x" else "x"
    low, high = F.when(p[axis] < q[axis], p).otherwise(q), F.when(p[axis] < q[axis], q).otherwise(p)
    met = low[other] + _rounded((border - low[axis]) * (high[other] - low[other]), F.greatest(high[axis] - low[axis], F.lit(1)))
    return F.struct((border if axis == "x" else met).cast("long").alias("x"), (border if axis == "y" else met).cast("long").alias("y"))


def _with_border_points(ring: Column) -> Column:
    """The ring with a point more wherever an edge crosses one of the tile's four border lines: crossings of whole edges, in order along each."""

    def edge(p: Column, i: Column) -> Column:
        q = F.get(ring, (i + 1) % F.size(ring))
        apart = lambda axis, c: ((p[axis] < c) & (q[axis] > c)) | ((p[axis] > c) & (q[axis] < c))
        found = F.array(*[F.when(apart(axis, F.col(c)), _crossing(p, q, axis, F.col(c))) for axis, c in (("x", "l"), ("x", "r"), ("y", "b"), ("y", "t"))])
        steps = F.transform(F.filter(found, lambda c: c.isNotNull()), lambda c: F.struct((F.abs(c["x"] - p["x"]) + F.abs(c["y"] - p["y"])).alias("at"), c.alias("c")))
        return F.concat(F.array(F.struct(p["x"].cast("long").alias("x"), p["y"].cast("long").alias("y"))), F.transform(F.array_sort(steps), lambda s: s["c"]))

    return F.flatten(F.transform(ring, edge))


def _half_plane(ring: Column, axis: str, border: Column, above: bool) -> Column:
    """The ring's part on one side of a border (Sutherland-Hodgman)."""
    inside = lambda p: p[axis] >= border if above else p[axis] <= border

    def step(q: Column, i: Column) -> Column:
        p = F.get(ring, F.pmod(i - 1, F.size(ring)))
        enters = F.when(inside(p) != inside(q), F.array(_crossing(p, q, axis, border))).otherwise(F.array().cast(f"array<{POINT}>"))
        return F.concat(enters, F.when(inside(q), F.array(q)).otherwise(F.array().cast(f"array<{POINT}>")))

    return F.flatten(F.transform(ring, step))


def cut_rings(rings: DataFrame, areas: DataFrame, cell_e7: int, id_col: str = "id", ring_col: str = "ring") -> DataFrame:
    """id, tile_id, ring of the part of every polygon (id, ring of x and y, first point not repeated) in each tile.

    A concave polygon of several parts in one tile stays one ring, with bridges along the border. A part without area, as of a polygon that
    only touches a tile, is left out.
    """
    ring = F.transform(ring_col, lambda p: F.struct(p["x"].cast("long").alias("x"), p["y"].cast("long").alias("y")))
    boxed = rings.select(id_col, ring.alias("ring")).where(F.size("ring") > 2)
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    bounds = {"x_lo": F.array_min(xs), "x_hi": F.array_max(xs), "y_lo": F.array_min(ys), "y_hi": F.array_max(ys)}
    cut = _meeting(boxed.withColumns(bounds), areas, cell_e7)
    steps = [_with_border_points(F.col("ring"))]
    steps += [_half_plane(F.col("ring"), axis, F.col(border), above) for axis, border, above in (("x", "l", True), ("x", "r", False), ("y", "b", True), ("y", "t", False))]
    steps.append(F.filter("ring", lambda p, i: p != F.get("ring", F.pmod(i - 1, F.size("ring")))))  # a point that repeats the one before adds nothing
    for step in steps:
        cut = _once(cut, "ring", step)
    return _once(cut, "double_area", double_area(F.col("ring"))).where((F.size("ring") > 2) & (F.col("double_area") != 0)).select(id_col, "tile_id", "ring")


def _apart(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that filters after them read as they are. Else the filter goes into the join below with all of them written out, for every pair of the cell."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """df with a column that is computed here and not merged into expressions that name it several times: that would double it with every step."""
    others = [F.col(c) for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(column)).alias(name))


def double_area(ring: Column) -> Column:
    """Twice the signed area of a ring, exact in whole numbers."""
    wide = lambda c: c.cast("decimal(20,0)")

    def term(p: Column, i: Column) -> Column:
        q = F.get(ring, (i + 1) % F.size(ring))
        return (wide(p["x"]) * wide(q["y"]) - wide(q["x"]) * wide(p["y"])).cast("decimal(38,0)")

    return F.aggregate(F.transform(ring, term), F.lit(0).cast("decimal(38,0)"), lambda a, t: (a + t).cast("decimal(38,0)"))
