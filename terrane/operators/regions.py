"""Points in polygons of any size: polygons as a table of quadtree cells, so that a point tests few edges or none.

A polygon's rings are cut into cells by a quadtree: cells without a border are inside or outside as a whole, those
with a border are split until they hold few edges. What is stored for a point of such a cell is exact: the edges between it and the cell's right
side, and whether the right side is inside, as the rows at which that changes. Points join cells by equality, at
as many levels as the polygons have (one for each power of two of their size); the plan has the same size for any ring.

Inside is even-odd over all rings; a lower or left edge is inside, an upper or right one outside, in exact integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.session import checkpointed

#: Edges that a cell holds at most, unless it is a single point.
EDGES = 12
#: Cells and edges of a table that is sent to all executors, at most; others are joined by shuffle.
SENT = 200_000
#: Parts that a cell's points are dealt over in a shuffle: a city may lie in one cell.
SALTS = 16
LEAF = "struct<x: long, y: long, size: long, toggles: array<long>, edges: array<struct<xa: long, ya: long, dx: long, dy: long, lo: long, hi: long>>>"
CELL = f"level int, cx long, cy long, whole boolean, leaves array<{LEAF}>"


def _rows_right(edge: tuple, column: int) -> tuple[int, int]:
    """The rows [lo, hi) at which an upward edge is to the right of a column."""
    xa, ya, dx, dy = edge
    top = ya + dy
    if dx == 0:
        return (ya, top) if xa > column else (ya, ya)
    if dx > 0:
        return min(max(ya + (column - xa) * dy // dx + 1, ya), top), top
    return ya, min(max(ya - (xa - column) * dy // dx, ya), top)


def _rows_within(edge: tuple, x: int, y: int, size: int) -> tuple[int, int]:
    """The rows of a cell at which the edge is right of the cell's first column and not of its last."""
    a, b = _rows_right(edge, x), _rows_right(edge, x + size - 1)
    lo, hi = (a[0], b[0]) if edge[2] > 0 else (b[1], a[1])
    if edge[2] == 0:
        lo, hi = (b[1], a[1]) if a[1] > a[0] else (0, 0)
    return max(lo, y), min(hi, y + size)


def _restricted(toggles: set[int], y: int, size: int) -> set[int]:
    """Changes of state within the rows; one at the first row stands for all before it."""
    out = {t for t in toggles if y < t < y + size}
    if sum(t <= y for t in toggles) % 2:
        out.add(y)
    return out


def quadtree(rings: Iterable[Sequence[tuple[int, int]]], side: int | None = None) -> Iterator[tuple[int, int, int, bool, list]]:
    """(level, cx, cy, whole, leaves) of the cells of side 2**level, and at most ``side``, in which a point may be inside."""
    edges = []
    for ring in rings:
        points = [(int(x), int(y)) for x, y in ring]
        for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1], strict=True):
            if y1 != y2:
                (xa, ya), (xb, yb) = ((x1, y1), (x2, y2)) if y1 < y2 else ((x2, y2), (x1, y1))
                edges.append((xa, ya, xb - xa, yb - ya))
    if not edges:
        return
    left, right = (f(f(e[0], e[0] + e[2]) for e in edges) for f in (min, max))
    low, high = min(e[1] for e in edges), max(e[1] + e[3] for e in edges)
    root = max(right - left, high - low, 1).bit_length()
    level = root
    while level and ((right - left >> level) + 1) * ((high - low >> level) + 1) < min(max(64, 2 * len(edges)), 1 << 16):
        level -= 1
    level = min(level, max(side, 1).bit_length() - 1) if side else level
    found: dict[tuple[int, int], list | None] = {}
    stack = [(left >> root << root, low >> root << root, root + 1, edges, set())]
    while stack:
        x, y, k, mine, toggles = stack.pop()
        size = 1 << k
        if not mine and not toggles - {y}:
            if toggles and k >= level:
                found.update({(cx, cy): None for cx in range(x >> level, x + size >> level) for cy in range(y >> level, y + size >> level)})
            elif toggles:
                found.setdefault((x >> level, y >> level), []).append((x, y, size, [y], []))
        elif k <= level and (len(mine) <= EDGES or k == 0):
            spans = [(*e, *_rows_within(e, x, y, size)) for e in mine]
            found.setdefault((x >> level, y >> level), []).append((x, y, size, sorted(toggles), spans))
        else:
            half = size >> 1
            west = set(toggles)  # of the column before the middle: edges between it and the last column change its state
            for e in mine:
                for column in (x + half - 1, x + size - 1):
                    lo, hi = _rows_right(e, column)
                    lo, hi = max(lo, y), min(hi, y + size)
                    if lo < hi:
                        west ^= {lo}
                        west ^= {hi}
            west.discard(y + size)
            for cx, state in ((x, west), (x + half, toggles)):
                for cy in (y, y + half):
                    stack.append((cx, cy, k - 1, [e for e in mine if (s := _rows_within(e, cx, cy, half))[0] < s[1]], _restricted(state, cy, half)))
    for (cx, cy), leaves in found.items():
        yield level, cx, cy, leaves is None, leaves or []


def ring_table(spark: SparkSession, rings: Sequence[Sequence[tuple[int, int]]], area: int = 0) -> DataFrame:
    """One area (area, rings) of rings that the driver has read."""
    return spark.createDataFrame([(area, [[(int(x), int(y)) for x, y in r] for r in rings])], "area long, rings array<array<struct<x: long, y: long>>>")


def region_cells(areas: DataFrame, area_col: str = "area", rings_col: str = "rings", side: int | None = None) -> DataFrame:
    """area and the columns of CELL for every area; a null or empty list of rings has no cells. Tasks hold one polygon at a time."""
    kind = areas.schema[area_col].dataType.simpleString()
    names = ["level", "cx", "cy", "whole", "leaves"]
    edge = pa.struct([(c, pa.int64()) for c in ("xa", "ya", "dx", "dy", "lo", "hi")])
    leaf = pa.struct([("x", pa.int64()), ("y", pa.int64()), ("size", pa.int64()), ("toggles", pa.list_(pa.int64())), ("edges", pa.list_(edge))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rings = batch.column(1)[i].as_py() or []
                rows = list(quadtree([[(p["x"], p["y"]) for p in r or () if p and p["x"] is not None and p["y"] is not None] for r in rings], side))
                leaves = [[dict(zip(("x", "y", "size", "toggles"), f, strict=False)) | {"edges": [dict(zip(("xa", "ya", "dx", "dy", "lo", "hi"), e, strict=True)) for e in f[4]]} for f in r[4]] for r in rows]
                columns = [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.bool_()))]
                area = batch.column(0).take(pa.array([i] * len(rows), pa.int64()))
                yield pa.RecordBatch.from_arrays([area, *columns, pa.array(leaves, pa.list_(leaf))], ["area", *names])

    return areas.select(F.col(area_col).alias("area"), F.col(rings_col).alias("rings")).mapInArrow(run, f"area {kind}, {CELL}")


def _inside(x: Column, y: Column, leaves: Column) -> Column:
    """Whether a point of a cell with a border is inside."""
    leaf = F.get(F.filter(leaves, lambda f: (x >= f["x"]) & (x < f["x"] + f["size"]) & (y >= f["y"]) & (y < f["y"] + f["size"])), F.lit(0))
    toggles = F.filter(leaf["toggles"], lambda t: t <= y)
    right = F.filter(leaf["edges"], lambda e: (y >= e["lo"]) & (y < e["hi"]) & ((x - e["xa"]) * e["dy"] < (y - e["ya"]) * e["dx"]))
    return F.coalesce((F.size(toggles) + F.size(right)) % 2 == 1, F.lit(False))


def locate(points: DataFrame, areas: DataFrame, area_col: str = "area", rings_col: str = "rings", lat: str = "lat_e7", lon: str = "lon_e7", side: int | None = None) -> DataFrame:
    """The columns of ``points`` and the area, as __area, of each area that a point is in; points without coordinates are in none.

    Cells go to all executors if their number and that of their edges allow; else both sides are shuffled by cell, with the points of a cell in SALTS parts.
    """
    cells = checkpointed(region_cells(areas, area_col, rings_col, side))
    weight, levels = cells.agg(F.sum(1 + F.aggregate("leaves", F.lit(0), lambda a, f: a + 1 + F.size(f["edges"]))), F.collect_set("level")).first()
    if not levels:
        return points.withColumn("__area", F.lit(None).cast(cells.schema["area"].dataType)).where(F.lit(False))
    x, y = F.col(lon).cast("long"), F.col(lat).cast("long")
    keys = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(x, k).alias("cx"), F.shiftright(y, k).alias("cy")) for k in sorted(levels)])
    named = cells.select(F.struct("level", "cx", "cy").alias("__cell"), F.col("area").alias("__area"), F.col("whole").alias("__whole"), F.col("leaves").alias("__leaves"))
    placed = points.where(x.isNotNull() & y.isNotNull()).withColumn("__cell", F.explode(keys) if len(levels) > 1 else keys[0])
    on = ["__cell"]
    if (weight or 0) <= SENT:
        named = F.broadcast(named)  # bounded by SENT
    else:
        named = named.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        placed, on = placed.withColumn("__salt", F.pmod(F.xxhash64(lon, lat), F.lit(SALTS)).cast("int")), [*on, "__salt"]
    met = placed.join(named, on).where(F.col("__whole") | _inside(x, y, F.col("__leaves")))
    return met.select(*[F.col(f"`{c}`") for c in points.columns], "__area")
