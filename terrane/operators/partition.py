"""Density-driven partitioning into rectangular tiles that meet exactly."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.operators import regions
from terrane.operators.graphs import descendants
from terrane.session import checkpointed, shuffled

#: World in 1e-7 degrees.
WORLD = (-1800000000, -900000000, 1800000000, 900000000)
#: Corners of a rectilinear polygon that tiles fit exactly.
MOST_VERTICES = 40


def cell(column: str, low: int, size: int):
    return F.floor((F.col(column) - low) / size).cast("int")


def density(nodes: DataFrame, cell_e7: int, lat: str = "lat_e7", lon: str = "lon_e7") -> DataFrame:
    """Nodes by grid cell: the only thing that the splitting needs, and small whatever the input."""
    return nodes.groupBy(cell(lon, WORLD[0], cell_e7).alias("cx"), cell(lat, WORLD[1], cell_e7).alias("cy")).agg(F.count(F.lit(1)).alias("n"))


def split(histogram: Sequence[tuple[int, int, int]], most: int, cell_e7: int, trim: bool = True, first_id: int = 1, area: tuple[int, int, int, int] | None = None) -> list[tuple[int, int, int, int, int]]:
    """(tile_id, left, bottom, right, top) by recursive halving of the weight at cell borders.

    A tile of one cell stays whole even if it holds more than ``most``. ``trim`` cuts empty edges. ``area`` is the
    part of the grid to split (left, bottom, right, top in cells), the whole one by default.
    """
    cells = [c for c in histogram if c[2] > 0]
    out: list[tuple[int, int, int, int]] = []

    def box(part):
        return min(c[0] for c in part), min(c[1] for c in part), max(c[0] for c in part) + 1, max(c[1] for c in part) + 1

    def cut(part, area):
        area = box(part) if trim and part else area
        total = sum(c[2] for c in part)
        if total <= most or (area[2] - area[0] <= 1 and area[3] - area[1] <= 1):
            out.append(area)
            return
        axis = 0 if area[2] - area[0] >= area[3] - area[1] else 1
        by: dict[int, int] = {}
        for c in part:
            by[c[axis]] = by.get(c[axis], 0) + c[2]
        run, best = 0, None
        for k in range(area[axis], area[axis + 2] - 1):
            run += by.get(k, 0)
            score = abs(2 * run - total)
            if best is None or score < best[0]:
                best = (score, k + 1)
        k = best[1]
        low, high = list(area), list(area)
        low[axis + 2], high[axis] = k, k
        cut([c for c in part if c[axis] < k], tuple(low))
        cut([c for c in part if c[axis] >= k], tuple(high))

    if area:
        cut(cells, area)
    elif cells:
        n_x, n_y = -(-(WORLD[2] - WORLD[0] + 1) // cell_e7), -(-(WORLD[3] - WORLD[1] + 1) // cell_e7)
        cut(cells, (0, 0, n_x, n_y))
    to = lambda a: (WORLD[0] + a[0] * cell_e7, WORLD[1] + a[1] * cell_e7, WORLD[0] + a[2] * cell_e7, WORLD[1] + a[3] * cell_e7)
    return [(first_id + i, *to(a)) for i, a in enumerate(sorted(out))]


def mask(histogram: DataFrame, areas: DataFrame, cell_e7: int) -> DataFrame:
    """The histogram without the cells of which no area (area, rings) holds the middle."""
    middle = lambda c, low: (F.col(c).cast("long") * cell_e7 + (low + cell_e7 // 2)).alias
    placed = histogram.select("*", middle("cx", WORLD[0])("__x"), middle("cy", WORLD[1])("__y"))
    return regions.locate(placed, areas, lat="__y", lon="__x").select(*histogram.columns).distinct()


def rectangles(ring: Sequence[tuple[int, int]]) -> list[tuple[int, int, int, int]] | None:
    """A rectilinear ring of at most MOST_VERTICES as rectangles (left, bottom, right, top) that fill it without overlap; None for other rings.

    Between two neighbouring x of its corners the ring is a pile of rectangles, even-odd; those that go on unchanged in the next strip grow.
    """
    points = [tuple(map(int, p)) for p in ring]
    points = points[:-1] if points and points[0] == points[-1] else points
    sides = list(zip(points, points[1:] + points[:1], strict=True))
    if not points or len(points) > MOST_VERTICES or any(a[0] != b[0] and a[1] != b[1] for a, b in sides):
        return None
    xs, out, growing = sorted({x for x, _ in points}), [], {}
    for left, right in zip(xs, xs[1:], strict=False):
        ys = sorted(a[1] for a, b in sides if min(a[0], b[0]) <= left and max(a[0], b[0]) >= right and a[0] != b[0])
        spans = [s for s in zip(ys[::2], ys[1::2], strict=True) if s[0] < s[1]]
        out += [(growing[s], s[0], left, s[1]) for s in growing if s not in spans]
        growing = {s: growing.get(s, left) for s in spans}
    return sorted(out + [(start, s[0], xs[-1], s[1]) for s, start in growing.items()])


def fit(nodes: DataFrame, boxes: Sequence[tuple[int, int, int, int]], most: int, cell_e7: int, lat: str = "lat_e7", lon: str = "lon_e7") -> DataFrame:
    """box (from 1), tile, left, bottom, right, top, n: tiles that fill each rectangle exactly, with the nodes of each.

    Rectangles do not overlap. Each is halved by weight at grid lines, side by side with the others; its own borders stay where they are,
    on the grid or not. The histogram of a rectangle has at most one row a grid cell. Empty rectangles are one tile; nodes in none go.
    """
    areas = areas_table(nodes.sparkSession, [(i, *b) for i, b in enumerate(boxes, 1)])
    placed = assign(nodes.select(lat, lon), areas, cell_e7, lat=lat, lon=lon).withColumnRenamed("tile_id", "box")
    counts = placed.groupBy("box", cell(lon, WORLD[0], cell_e7).alias("cx"), cell(lat, WORLD[1], cell_e7).alias("cy")).agg(F.count(F.lit(1)).alias("n"))
    named = areas.withColumnRenamed("tile_id", "box")

    def tiles(pdf):
        a = pdf.iloc[0]
        edges = [int(a[c]) for c in ("left", "bottom", "right", "top")]
        low = [(edges[i] - WORLD[i]) // cell_e7 for i in (0, 1)]
        high = [-(-(edges[i + 2] - WORLD[i]) // cell_e7) for i in (0, 1)]
        known = pdf.dropna(subset=["n"])
        cells = list(zip(known.cx.astype(int), known.cy.astype(int), known.n.astype(int), strict=True))
        rows = []
        for k, (_, x1, y1, x2, y2) in enumerate(split(cells, most, cell_e7, trim=False, area=(*low, *high)), 1):
            inside = [c[2] for c in cells if x1 <= WORLD[0] + c[0] * cell_e7 < x2 and y1 <= WORLD[1] + c[1] * cell_e7 < y2]
            rows.append((int(a.box), k, max(x1, edges[0]), max(y1, edges[1]), min(x2, edges[2]), min(y2, edges[3]), sum(inside)))
        return pd.DataFrame(rows, columns=["box", "tile", "left", "bottom", "right", "top", "n"])

    return named.join(counts, "box", "left").groupBy("box").applyInPandas(tiles, "box long, tile long, left long, bottom long, right long, top long, n long")


def areas_table(spark, areas: Sequence[tuple[int, int, int, int, int]]) -> DataFrame:
    return spark.createDataFrame([tuple(map(int, a)) for a in areas], "tile_id long, left long, bottom long, right long, top long")


def assign(nodes: DataFrame, areas: DataFrame, cell_e7: int, overlap_e7: int = 0, lat: str = "lat_e7", lon: str = "lon_e7") -> DataFrame:
    """(node columns, tile_id): tiles are half-open, so that a node is in one tile; with an overlap in up to four.

    Tiles are spread over grid cells, so that this is an equi-join with a residual test, not a test of all pairs.
    """
    xs = F.sequence(F.floor((F.col("left") - overlap_e7 - WORLD[0]) / cell_e7).cast("int"), F.floor((F.col("right") + overlap_e7 - 1 - WORLD[0]) / cell_e7).cast("int"))
    ys = F.sequence(F.floor((F.col("bottom") - overlap_e7 - WORLD[1]) / cell_e7).cast("int"), F.floor((F.col("top") + overlap_e7 - 1 - WORLD[1]) / cell_e7).cast("int"))
    cells = areas.withColumn("cx", F.explode(xs)).withColumn("cy", F.explode(ys))
    placed = nodes.withColumn("cx", cell(lon, WORLD[0], cell_e7)).withColumn("cy", cell(lat, WORLD[1], cell_e7)).join(cells, ["cx", "cy"])
    inside = (F.col(lon) >= F.col("left") - overlap_e7) & (F.col(lon) < F.col("right") + overlap_e7) & (F.col(lat) >= F.col("bottom") - overlap_e7) & (F.col(lat) < F.col("top") + overlap_e7)
    return placed.where(inside).select(*nodes.columns, "tile_id")


def way_tiles(way_nodes: DataFrame, node_tiles: DataFrame) -> DataFrame:
    """Tiles of the nodes of each way."""
    return way_nodes.join(node_tiles.select(F.col("id").alias("node_id"), "tile_id"), "node_id").select("way_id", "tile_id").distinct()


def bbox_tiles(boxes: DataFrame, areas: DataFrame, id_col: str, cell_e7: int) -> DataFrame:
    """Tiles that each box meets: what keeps problem ways and relations complete."""
    spread = lambda df, a, b, low: F.sequence(F.floor((F.col(a) - low) / cell_e7).cast("int"), F.floor((F.col(b) - low) / cell_e7).cast("int"))
    left = boxes.withColumn("cx", F.explode(spread(boxes, "left", "right", WORLD[0]))).withColumn("cy", F.explode(spread(boxes, "bottom", "top", WORLD[1])))
    names = {"left": "l", "bottom": "b", "right": "r", "top": "t"}
    tiles = areas.withColumn("cx", F.explode(spread(areas, "left", "right", WORLD[0]))).withColumn("cy", F.explode(spread(areas, "bottom", "top", WORLD[1]))).withColumnsRenamed(names)
    met = left.join(tiles, ["cx", "cy"]).where("`left` < r and `right` >= l and bottom < t and top >= b")
    return met.select(id_col, "tile_id").distinct()


def complete_tiles(members: DataFrame, roots: DataFrame, tiles: DataFrame) -> DataFrame:
    """(member, tile_id): every member of a problem relation, however deep, in all tiles that any of its members is in."""
    held = checkpointed(descendants(members, roots))
    needed = held.join(tiles, "member").select("root", "tile_id").distinct()
    return held.join(needed, "root").select("member", "tile_id").distinct()


def crowding(places: DataFrame, lat: str = "p_lat", lon: str = "p_lon", most: float = 4.0, halvings: int = 20) -> int:
    """The largest cell size, of the world's width halved up to ``halvings`` times, at which a place shares its cell with ``most`` places on average, itself counted."""
    sizes = [(WORLD[2] - WORLD[0]) >> i for i in range(halvings + 1)]
    levels = F.explode(F.array(*[F.lit(s).cast("long") for s in sizes]))
    at = lambda c, low: F.floor((F.col(c) - low) / F.col("size"))
    shared = places.select(lat, lon, levels.alias("size")).groupBy("size", at(lon, WORLD[0]).alias("cx"), at(lat, WORLD[1]).alias("cy")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    known = shared.groupBy("size").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("mean"))
    found = known.where(F.col("mean") <= most).agg(F.max("size")).first()[0]
    return sizes[-1] if found is None else found


def nearest(points: DataFrame, places: DataFrame, id_col: str, name_col: str, cell_e7: int | None = None) -> DataFrame:
    """For each point the nearest place by squared distance in degrees, ties to the smaller name.

    A point meets the places of its grid cell and the eight around it. A find within one cell's size
    is the nearest of all; the points without one go on to a grid of double the size. The first grid follows how densely places
    lie. Points far from places that crowd together still meet many of them.
    """
    p = places.select(F.col("lat_e7").alias("p_lat"), F.col("lon_e7").alias("p_lon"), F.col(name_col).alias("place"))
    p = checkpointed(p.groupBy("p_lat", "p_lon").agg(F.min("place").alias("place")))
    dx, dy = (F.col("lon_e7") - F.col("p_lon")).cast("double"), (F.col("lat_e7") - F.col("p_lat")).cast("double")
    around = lambda c: F.explode(F.array(c - 1, c, c + 1))
    left, out, size = points.select(id_col, "lat_e7", "lon_e7"), None, cell_e7 or crowding(p)
    while True:
        near = p.withColumn("cx", around(cell("p_lon", WORLD[0], size))).withColumn("cy", around(cell("p_lat", WORLD[1], size)))
        # Without the shuffle the points of a small file would meet their places in one task.
        met = left.withColumn("cx", cell("lon_e7", WORLD[0], size)).withColumn("cy", cell("lat_e7", WORLD[1], size)).join(shuffled(near), ["cx", "cy"], "left")
        d = F.struct((dx * dx + dy * dy).alias("d"), "place")
        best = checkpointed(met.groupBy(id_col).agg(F.first("lat_e7").alias("lat_e7"), F.first("lon_e7").alias("lon_e7"), F.min(F.when(F.col("place").isNotNull(), d)).alias("best")))
        sure = F.coalesce(F.col("best.d") <= float(size) ** 2, F.lit(False)) if size < WORLD[2] - WORLD[0] else F.lit(True)
        found = best.where(sure).select(id_col, "best.place")
        out = found if out is None else out.unionByName(found)
        left = best.where(~sure).select(id_col, "lat_e7", "lon_e7")
        if size >= WORLD[2] - WORLD[0] or not left.take(1):
            return out
        size *= 2


def largest_first(df: DataFrame, weight: str, id_col: str) -> DataFrame:
    """Add ``rank`` from 1, largest weight first, ties by id: ranges are ranked side by side, and their counts, a row a range, give the offsets."""
    order = [F.desc(weight), F.col(id_col)]
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()))
    sizes = ranged.groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("range_no").orderBy(*order))
    return ranged.withColumn("inside", inside).join(bases, "range_no").select(*df.columns, (F.col("base") + F.col("inside")).cast("int").alias("rank"))
