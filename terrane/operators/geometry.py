"""Geometry of ways and points, and tile numbers. Coordinates are integers of 1e-7 degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: mean radius of the earth in metres.
RADIUS = 6371000.0


def way_points(way_nodes: DataFrame, nodes: DataFrame) -> DataFrame:
    return way_nodes.join(nodes.select(F.col("id").alias("node_id"), "lat_e7", "lon_e7"), "node_id")


def way_bbox(points: DataFrame) -> DataFrame:
    return points.groupBy("way_id").agg(F.min("lon_e7").alias("left"), F.min("lat_e7").alias("bottom"), F.max("lon_e7").alias("right"), F.max("lat_e7").alias("top"))


def way_lines(points: DataFrame) -> DataFrame:
    """way_id and its points in order."""
    return points.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("seq", "node_id", "lon_e7", "lat_e7"))).alias("points"))


def is_closed(points: Column) -> Column:
    """First node is last node; false for an empty way."""
    return F.coalesce(F.get(points, F.lit(0))["node_id"] == F.try_element_at(points, F.lit(-1))["node_id"], F.lit(False))


def kind(points: Column) -> Column:
    return F.when(is_closed(points) & (F.size(points) >= 3), "polygon").otherwise("line")


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres between two points."""
    r = lambda c: F.radians(c / 1e7)
    a = F.pow(F.sin((r(lat2) - r(lat1)) / 2), 2) + F.cos(r(lat1)) * F.cos(r(lat2)) * F.pow(F.sin((r(lon2) - r(lon1)) / 2), 2)
    return F.lit(2 * RADIUS) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def segments(points: Column) -> Column:
    """Pairs of neighbouring points."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    return F.arrays_zip(F.slice(points, F.lit(1), n).alias("a"), F.slice(points, F.lit(2), n).alias("b"))


def length(points: Column) -> Column:
    return F.aggregate(segments(points), F.lit(0.0), lambda s, e: s + haversine(e["a"]["lon_e7"], e["a"]["lat_e7"], e["b"]["lon_e7"], e["b"]["lat_e7"]))


def area2_micro(points: Column) -> Column:
    """Twice the signed shoelace area in square micro-degrees, exact: coordinates count in steps of 1e-4 degrees."""
    g = lambda p, c: (p[c] / 1000).cast("long")
    return F.aggregate(segments(points), F.lit(0).cast("long"), lambda s, e: s + g(e["a"], "lon_e7") * g(e["b"], "lat_e7") - g(e["b"], "lon_e7") * g(e["a"], "lat_e7"))


def morton(lat_e7: Column, lon_e7: Column) -> Column:
    """Quantised to 16 bits each and interleaved: bits of x above those of y."""
    y = F.round((lat_e7 / 1e7 + 90) * 65535 / 180).cast("long")
    x = F.round((lon_e7 / 1e7 + 180) * 65535 / 360).cast("long")
    out = F.lit(0).cast("long")
    for i in range(16):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(x, i).bitwiseAND(F.lit(1)), 2 * i + 1)).bitwiseOR(F.shiftleft(F.shiftright(y, i).bitwiseAND(F.lit(1)), 2 * i))
    return out


def slippy(lat_e7: Column, lon_e7: Column, zoom: int) -> tuple[Column, Column]:
    """Map tile x and y; latitudes beyond the projection fall into the outer rows."""
    n = 1 << zoom
    lat = F.radians(F.greatest(F.least(lat_e7 / 1e7, F.lit(85.0511)), F.lit(-85.0511)))
    x = F.floor(F.round((lon_e7 / 1e7 + 180) / 360 * n, 6))
    y = F.floor(F.round((1 - F.log(F.tan(lat) + 1 / F.cos(lat)) / 3.141592653589793) / 2 * n, 6))
    last = F.lit(n - 1)
    return F.least(F.greatest(x, F.lit(0)), last).cast("long"), F.least(F.greatest(y, F.lit(0)), last).cast("long")


def wrap32(x: Column) -> Column:
    """An unsigned 32-bit number as a signed one."""
    return F.when(x >= 2**31, x - 2**32).otherwise(x)
