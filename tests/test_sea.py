"""Coastlines: joining against a walk, land by tile against exact clipping of whole polygons."""

import math
import random
from fractions import Fraction

from terrane.operators import sea

TILE = 300_000_000


def walk(pieces):
    """(id, ring, position, closed) by following pieces one by one."""
    begins, ends = {}, {}
    for i, a, b in sorted(pieces):
        if a != b:
            begins.setdefault(a, i)
            ends.setdefault(b, i)
    after = {ends[n]: begins[n] for n in begins if n in ends}
    before = {v: k for k, v in after.items()}
    out = {i: (i, 0, True) for i, a, b in pieces if a == b}
    for i, a, b in sorted(pieces):
        if i in out:
            continue
        at, seen = i, {i}
        while at in before and before[at] not in seen:
            at = before[at]
            seen.add(at)
        ring = at in before and before[at] in seen
        at = min(seen | {i}) if ring else at
        name, n = at, 0
        while at is not None and at not in out:
            out[at] = (name, n, ring)
            at, n = after.get(at), n + 1
    return sorted((i, *v) for i, v in out.items())


def test_pieces_join_as_a_walk_does(spark):
    r = random.Random(5)
    pieces, node = [], 0
    for size, closed in ((1, True), (1, False), (2, True), (3, False), (16, True), (17, True), (90, True), (65, False)):
        nodes = list(range(node, node + size + (not closed)))
        node += len(nodes)
        pieces += [(nodes[i], nodes[(i + 1) % len(nodes)]) for i in range(size)]
    pieces += [(3, 4), (4, 9), (node + 5, node + 5)]  # branches and a closed way
    ids = r.sample(range(10_000), len(pieces))
    rows = [(i, *p) for i, p in zip(ids, pieces)]
    got = sea.join_pieces(spark.createDataFrame(rows, "id long, first_node long, last_node long"))
    assert sorted(map(tuple, got.collect())) == walk(rows)


def clipped_double_area(ring, l, b, r, t):
    """Twice the signed area of a ring's part in a box, in fractions."""
    pts = [(Fraction(x), Fraction(y)) for x, y in ring]
    for axis, border, sign in ((0, l, 1), (0, r, -1), (1, b, 1), (1, t, -1)):
        out = []
        for i, q in enumerate(pts):
            p = pts[i - 1]
            inside = [(c[axis] - border) * sign >= 0 for c in (p, q)]
            if inside[0] != inside[1]:
                f = (border - p[axis]) / (q[axis] - p[axis])
                out.append(tuple(p[k] + f * (q[k] - p[k]) for k in (0, 1)))
            if inside[1]:
                out.append(q)
        pts = out
    return sum(pts[i - 1][0] * q[1] - q[0] * pts[i - 1][1] for i, q in enumerate(pts))


def rings_as_tables(spark, rings):
    pieces, points, node = [], [], 0
    for ring in rings:
        for i, p in enumerate(ring):
            q = ring[(i + 1) % len(ring)]
            pieces.append((node + i, node + i, node + (i + 1) % len(ring)))
            points += [(node + i, 0, *p), (node + i, 1, *q)]
        node += len(ring)
    return spark.createDataFrame(pieces, "id long, first_node long, last_node long"), spark.createDataFrame(points, "id long, seq int, lon_e7 long, lat_e7 long")


def test_land_by_tile_equals_exact_clipping(spark):
    r = random.Random(8)
    star = [(round(x * d), round(y * d)) for x, y, d in ((math.cos(i * math.tau / 40), math.sin(i * math.tau / 40), r.randint(200_000_000, 850_000_000)) for i in range(40))]
    lake = [(-90_000_001, -3), (-7, 80_000_001), (110_000_003, 11), (5, -100_000_007)]
    island = [(900_000_000, -900_000_000), (1_200_000_000, -900_000_000), (1_200_000_000, -600_000_000), (900_000_000, -600_000_000)]  # one whole tile
    rings = [star, lake, island]
    pieces, points = rings_as_tables(spark, rings)
    members = sea.join_pieces(pieces)
    parts = sea.coast_segments(members, points)
    kinds = {x.ring: x.kind for x in sea.ring_areas(parts).collect()}
    assert kinds == {0: "land", 40: "lake", 44: "land"}
    got = {(x.column, x.row): (int(x.double_land), x.kind) for x in sea.sea_tiles(parts, TILE).collect()}
    assert len(got) == 12 * 6
    for (column, row), (land, kind) in got.items():
        l, b = column * TILE - 1_800_000_000, row * TILE - 900_000_000
        want = sum(clipped_double_area(ring, l, b, l + TILE, b + TILE) for ring in rings)
        assert abs(land - want) <= 40 * TILE  # crossings are rounded to whole units
        if kind != "mixed":
            assert want == (2 * TILE * TILE if kind == "land" else 0)
    assert got[9, 0] == (2 * TILE * TILE, "land")


def test_open_coasts_gaps_and_empty_tables(spark):
    square = [(0, 0), (TILE, 0), (TILE, TILE), (0, TILE)]
    pieces, points = rings_as_tables(spark, [square])
    members = sea.join_pieces(pieces.where("id <> 3").union(pieces.where("id = 1")))  # one piece missing, one repeated
    for gap in (0, TILE):
        assert [tuple(x) for x in members.orderBy("position").collect()] == [(0, 0, 0, False), (1, 0, 1, False), (2, 0, 2, False)]
        parts = sea.coast_segments(members, points, gap)
        land = sea.sea_tiles(parts, TILE).where("double_land > 0").collect()
        assert [(x.column, x.row, x.kind) for x in land] == ([(6, 3, "land")] if gap else [])
    none = sea.coast_segments(sea.join_pieces(pieces.limit(0)), points)
    assert sea.sea_tiles(none, TILE).where("kind = 'sea'").count() == 72
    nulls = spark.createDataFrame([(1, None, 2), (2, 2, None)], "id long, first_node long, last_node long")
    assert sorted(map(tuple, sea.join_pieces(nulls).collect())) == [(1, 1, 0, False), (2, 1, 1, False)]


def test_no_table_of_pieces_is_sent_whole(spark, tmp_path, monkeypatch):
    """Small files may hold millions of pieces, so the planner's estimate by their bytes must not make them broadcasts."""
    plans = []

    def seen(run):
        def wrapped(df, *args):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return run(df, *args)

        return wrapped

    monkeypatch.setattr(sea, "checkpointed", seen(sea.checkpointed))
    monkeypatch.setattr(sea, "stored", seen(sea.stored))
    pieces, points = rings_as_tables(spark, [[(0, 0), (TILE, 0), (TILE, TILE)], [(0, 0), (-TILE, 0), (-TILE, -TILE)]])
    for name, df in (("pieces", pieces), ("points", points)):
        df.write.parquet(f"{tmp_path}/{name}")
    members = sea.join_pieces(spark.read.parquet(f"{tmp_path}/pieces"))
    members.write.parquet(f"{tmp_path}/members")
    parts = sea.coast_segments(spark.read.parquet(f"{tmp_path}/members"), spark.read.parquet(f"{tmp_path}/points"), 10)
    plans.append(parts._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 4 and sum(p.count("SortMergeJoin") for p in plans) > 4
    assert not [p for p in plans if "Broadcast" in p]
