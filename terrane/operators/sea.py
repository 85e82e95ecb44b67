"""Sea and land of tiles from directed coastline pieces (land to the left), without putting a ring together in one row.

Pieces are joined end to end by pointer jumping, so a coast of n pieces takes log2 n joins on keys that occur once. Land in a tile is an
integral along the coast: a stretch inside counts what lies to its left within the tile, one further right in the same row of tiles
counts the whole width. The sum over a row of tiles from the right is also what floods tiles that no coast touches.

Defined results: of several pieces that begin (or end) at one node, the smallest id goes on; the others stay chains. Rings without
area, tables without pieces and coasts that do not close leave sea. Pieces with a null end stay alone; of pieces with one id the least counts; points with a null coordinate are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.operators import cutting
from terrane.operators.partition import WORLD
from terrane.session import checkpointed, discard, shuffled, stored

WIDE = "decimal(20,0)"


def _wide(c: Column) -> Column:
    return c.cast(WIDE)


def _jumped(before: DataFrame) -> tuple[DataFrame, str]:
    """(id, far, steps, done, least) from (id, before), and the folder that they are in: the first piece of a chain and the steps to it, or, where ``done`` is
    false, pieces on a ring with its smallest id in ``least``."""
    start = F.col("before").isNull()
    names = ["far", "steps", "done", "least"]
    first = [F.coalesce("before", "id"), (~start).cast("long"), start, F.col("id")]
    spark, last = before.sparkSession, None
    state, path = stored(before.select("id", F.struct(*[c.alias(n) for n, c in zip(names, first)]).alias("s")), "coast")
    while True:
        active = F.expr("count_if(NOT s.done)"), F.expr("sum(if(s.done, 0, cast(s.least AS decimal(38,0))))")
        mark = tuple(state.agg(*active).first())
        if not mark[0] or mark == last:
            # Minima over windows of twice the length that are all the same as before are those of whole rings.
            return state.select("id", "s.*"), path
        last = mark
        # A piece that is done meets itself: every key occurs once on both sides, and the partitions stay as many as they are.
        ahead = state.select(F.col("id").alias("__key"), F.col("s").alias("t"))
        met = state.withColumn("__key", F.when(F.col("s.done"), F.col("id")).otherwise(F.col("s.far"))).join(shuffled(ahead), "__key")
        step = [F.col("t.far"), F.col("s.steps") + F.col("t.steps"), F.col("t.done"), F.least("s.least", "t.least")]
        moved = F.struct(*[c.alias(n) for n, c in zip(names, step)])
        old = path
        state, path = stored(met.select("id", F.when(F.col("s.done"), F.col("s")).otherwise(moved).alias("s")), "coast")
        discard(spark, old)


def join_pieces(pieces: DataFrame) -> DataFrame:
    """(id, ring, position, closed) of pieces (id, first_node, last_node).

    A ring is named by its smallest piece, at position 0; a chain that does not close by its first one.
    """
    pieces = pieces.groupBy("id").agg(F.min(F.struct("first_node", "last_node")).alias("__p")).select("id", "__p.*")
    alone = F.col("first_node") == F.col("last_node")
    open_pieces = pieces.where(~F.coalesce(alone, F.lit(False)))
    begins = open_pieces.where("first_node IS NOT NULL").groupBy(F.col("first_node").alias("node")).agg(F.min("id").alias("id"))
    ends = open_pieces.where("last_node IS NOT NULL").groupBy(F.col("last_node").alias("node")).agg(F.min("id").alias("before"))
    linked = open_pieces.select("id").join(shuffled(begins.join(shuffled(ends), "node").select("id", "before")), "id", "left")
    linked = checkpointed(linked)
    state, first = _jumped(linked)
    chains = state.where("done").select("id", F.col("far").alias("ring"), F.col("steps").alias("position"), F.lit(False).alias("closed"))
    on_rings = state.where("NOT done").select("id", F.col("least").alias("ring"))
    cut = on_rings.join(shuffled(linked), "id").select("id", F.when(F.col("id") != F.col("ring"), F.col("before")).alias("before"))
    ranks, second = _jumped(cut)
    placed = ranks.select("id", F.col("far").alias("ring"), F.col("steps").alias("position"), F.lit(True).alias("closed"))
    single = pieces.where(alone).select("id", F.col("id").alias("ring"), F.lit(0).cast("long").alias("position"), F.lit(True).alias("closed"))
    out = checkpointed(chains.unionByName(placed).unionByName(single))
    for path in (first, second):
        discard(out.sparkSession, path)
    return out


def coast_segments(members: DataFrame, points: DataFrame, gap_e7: int = 0) -> DataFrame:
    """(ring, x1, y1, x2, y2) of all rings; points (id, seq, lon_e7, lat_e7) are those of the pieces.

    A chain whose ends are within ``gap_e7`` of each other in both coordinates is closed by a straight line.
    """
    parts = cutting.segments(points.where("lon_e7 IS NOT NULL AND lat_e7 IS NOT NULL"), "id").join(shuffled(members), "id")
    ends = parts.where("NOT closed").groupBy("ring").agg(
        F.max_by(F.struct("x2", "y2"), F.struct("position", "seq")).alias("a"), F.min_by(F.struct("x1", "y1"), F.struct("position", "seq")).alias("b")
    )
    near = ends.where((F.abs(F.col("a.x2") - F.col("b.x1")) <= gap_e7) & (F.abs(F.col("a.y2") - F.col("b.y1")) <= gap_e7))
    closing = near.select("ring", F.col("a.x2").alias("x1"), F.col("a.y2").alias("y1"), F.col("b.x1").alias("x2"), F.col("b.y1").alias("y2"))
    columns = ["ring", "x1", "y1", "x2", "y2"]
    mended = parts.where("NOT closed").join(shuffled(near.select("ring")), "ring", "left_semi")
    return parts.where("closed").select(columns).unionByName(mended.select(columns)).unionByName(closing)


def ring_areas(segments: DataFrame) -> DataFrame:
    """(ring, double_area, kind): twice the signed area, land where it is positive, lake where negative."""
    term = (_wide(F.col("x1")) * _wide(F.col("y2")) - _wide(F.col("x2")) * _wide(F.col("y1"))).cast("decimal(38,0)")
    kind = F.when(F.col("double_area") > 0, "land").when(F.col("double_area") < 0, "lake").otherwise("none")
    return segments.groupBy("ring").agg(F.sum(term).cast("decimal(38,0)").alias("double_area")).withColumn("kind", kind)


def _cut(segments: DataFrame, axis: str, low: int, tile: int, name: str) -> DataFrame:
    """Segments cut at every border of one coordinate, with the number of the strip that each piece is in."""
    other = "y" if axis == "x" else "x"
    a, b = F.least(f"{axis}1", f"{axis}2"), F.greatest(f"{axis}1", f"{axis}2")
    strip = lambda c: F.expr(f"floor(({c} - {low}) / {tile})").cast("long")
    rows = segments.withColumns({"__a": a, "__b": b}).withColumns({"__i": strip("__a"), "__j": strip("__b")})
    # A segment that ends on a border from below has no stretch in the strip above it.
    rows = rows.withColumn("__j", F.when((F.col("__b") == F.col("__j") * tile + low) & (F.col("__j") > F.col("__i")), F.col("__j") - 1).otherwise(F.col("__j")))
    rows = rows.withColumn(name, F.explode(F.sequence("__i", "__j")))
    up = F.col(f"{axis}2") > F.col(f"{axis}1")
    bottom, top = F.greatest(F.col("__a"), F.col(name) * tile + low), F.least(F.col("__b"), (F.col(name) + 1) * tile + low)
    rows = rows.withColumns({"__from": F.when(up, bottom).otherwise(top), "__to": F.when(up, top).otherwise(bottom)})

    def crossing(at: str) -> Column:
        """The other coordinate there: exact, rounded half up, the same from both sides of a border."""
        span = F.greatest(F.abs(F.col(f"{axis}2") - F.col(f"{axis}1")), F.lit(1))
        sign = F.when(up, 1).otherwise(-1)
        inner = F.col(f"{other}1") + cutting._rounded((F.col(at) - F.col(f"{axis}1")) * sign * (F.col(f"{other}2") - F.col(f"{other}1")), span)
        return F.when(F.col(at) == F.col(f"{axis}1"), F.col(f"{other}1")).when(F.col(at) == F.col(f"{axis}2"), F.col(f"{other}2")).otherwise(inner)

    level = F.col(f"{axis}1") == F.col(f"{axis}2")
    ends = {f"{other}1": F.when(level, F.col(f"{other}1")).otherwise(crossing("__from")), f"{other}2": F.when(level, F.col(f"{other}2")).otherwise(crossing("__to"))}
    kept = [c for c in segments.columns if c not in ("x1", "y1", "x2", "y2")]
    return rows.select(*kept, name, F.col("__from").alias(f"{axis}1"), F.col("__to").alias(f"{axis}2"), *[c.alias(k) for k, c in ends.items()])


def sea_tiles(segments: DataFrame, tile_e7: int) -> DataFrame:
    """(column, row, double_land, kind) of every tile of the world: twice its land's area, and land, sea or mixed.

    Tiles are squares of ``tile_e7`` from the south-west corner; a tile over the world's edge counts as if it went on. Rings that
    overlap count several times. Segments meet in a row of tiles only after they are summed by tile.
    """
    left, bottom, right, top = WORLD
    columns, rows = -(-(right - left) // tile_e7), -(-(top - bottom) // tile_e7)
    pieces = _cut(_cut(segments.where("y1 <> y2"), "y", bottom, tile_e7, "row"), "x", left, tile_e7, "column")
    rise = F.col("y2") - F.col("y1")
    inside = _wide(F.col("x1") + F.col("x2") - 2 * (F.col("column") * tile_e7 + left)) * _wide(rise)
    sums = pieces.groupBy("column", "row").agg(F.sum(inside.cast("decimal(38,0)")).alias("inside"), F.sum(_wide(rise)).alias("rise"))
    grid = segments.sparkSession.range(columns * rows).select((F.col("id") % columns).alias("column"), F.expr(f"id div {columns}").alias("row"))
    further = Window.partitionBy("row").orderBy(F.col("column").desc()).rowsBetween(Window.unboundedPreceding, -1)  # at most ``columns`` rows
    whole = F.coalesce(F.sum("rise").over(further), F.lit(0)).cast(WIDE) * F.lit(2 * tile_e7).cast(WIDE)
    land = (F.coalesce("inside", F.lit(0).cast("decimal(38,0)")) + whole).cast("decimal(38,0)")
    full = F.lit(2 * tile_e7 * tile_e7).cast("decimal(38,0)")
    kind = F.when(F.col("double_land") == 0, "sea").when(F.col("double_land") == full, "land").otherwise("mixed")
    return grid.join(sums, ["column", "row"], "left").select("column", "row", land.alias("double_land")).withColumn("kind", kind)
