"""Polygons of any size against ray casting; lines and polygons cut on tile borders against fractions."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from terrane.operators import cutting, entities, partition, regions


def inside(rings, x, y):
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 <= y) != (y2 <= y) and x1 + Fraction((y - y1) * (x2 - x1), y2 - y1) > x:
                n += 1
    return n % 2 == 1


def comb(n: int, deep: int = 500_000) -> list[tuple[int, int]]:
    """A square's border with a tooth at every vertex."""
    out = []
    for i in range(n):
        side, t, d = i * 4 // n, (i % (n // 4)) * 4 * 1_600_000_000 // n - 800_000_000, (i * 7919 % 1000) * deep
        out.append([(t, d - 800_000_000), (800_000_000 - d, t), (-t, 800_000_000 - d), (d - 800_000_000, -t)][side])
    return out


def in_cells(cells, x, y):
    for level, cx, cy, whole, leaves in cells:
        if (x >> level, y >> level) == (cx, cy):
            for lx, ly, size, toggles, edges in leaves:
                if lx <= x < lx + size and ly <= y < ly + size:
                    return (sum(t <= y for t in toggles) + sum(lo <= y < hi and (x - xa) * dy < (y - ya) * dx for xa, ya, dx, dy, lo, hi in edges)) % 2 == 1
            return whole
    return False


@pytest.mark.parametrize("side", [None, 1, 4])
def test_quadtree_of_any_rings(side):
    rnd = random.Random(7)
    for _ in range(60):
        span, off = rnd.choice([3, 6, 20, 40]), rnd.choice([0, -10, -1000, 77])
        rings = [[(off + rnd.randrange(span), off + rnd.randrange(span)) for _ in range(rnd.choice([1, 3, 4, 8, 40]))] for _ in range(rnd.randint(1, 3))]
        cells = list(regions.quadtree(rings, side))
        assert len({c[1:3] for c in cells}) == len(cells)
        assert all(in_cells(cells, x, y) == inside(rings, x, y) for x in range(off - 2, off + span + 2) for y in range(off - 2, off + span + 2))


@pytest.mark.parametrize("sent", [regions.SENT, 10])
def test_clip_by_a_ring_of_3000_points(spark, monkeypatch, sent):
    monkeypatch.setattr(regions, "SENT", sent)
    rnd = random.Random(1)
    ring, hole = comb(3000), [(-100, -100), (200_000_000, 0), (0, 300_000_000)]
    spots = [(i, rnd.randrange(-10**9, 10**9), rnd.randrange(-9 * 10**8, 9 * 10**8)) for i in range(3000)] + [(5000 + i, *p) for i, p in enumerate(ring[::30] + hole)]
    frame = spark.createDataFrame([*spots, (9000, None, 5), (9001, None, None)], "id long, lon_e7 long, lat_e7 long")
    frame = frame.withColumn("level", F.lit("x")).withColumn("leaves", F.lit("y"))
    clipped = entities.polygon_clip(frame, [ring, hole])
    got = clipped.collect()
    assert {r.id for r in got} == {i for i, x, y in spots if inside([ring, hole], x, y)} and len({r.id for r in got}) == len(got)
    assert clipped.columns == ["id", "lon_e7", "lat_e7", "level", "leaves"]
    plan = clipped._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000  # whatever the ring
    assert entities.polygon_clip(frame, []).count() == 0 and entities.polygon_clip(frame, [[(0, 0), (5, 0)]]).count() == 0


def test_points_in_areas_of_all_sizes(spark):
    rnd = random.Random(2)
    areas = []
    for a in range(40):
        r, x, y = 10 ** rnd.randint(0, 8), rnd.randrange(-10**9, 10**9), rnd.randrange(-5 * 10**8, 5 * 10**8)
        areas.append((f"a{a}", [(x + rnd.randrange(-r, r + 1), y + rnd.randrange(-r, r + 1)) for _ in range(rnd.randint(3, 30))]))
    spots = [(i, rnd.randrange(-10**9, 10**9), rnd.randrange(-5 * 10**8, 5 * 10**8)) for i in range(500)]
    spots += [(1000 + i, p[0] + rnd.randrange(-2, 3), p[1] + rnd.randrange(-2, 3)) for i, p in enumerate(p for _, ring in areas for p in ring)]
    frame = spark.createDataFrame(areas, "area string, ring array<struct<x: long, y: long>>")
    got = entities.contained(spark.createDataFrame(spots, "id long, lon_e7 long, lat_e7 long"), frame, "id", "area").collect()
    want = {(i, a) for i, x, y in spots for a, ring in areas if inside([ring], x, y)}
    assert sorted(map(tuple, got)) == sorted(want)


def tiles(rnd, n=12, span=1000):
    """(tile_id, left, bottom, right, top) of a square that has been cut n - 1 times."""
    found = [(0, 0, span, span)]
    while len(found) < n:
        a = found.pop(rnd.randrange(len(found)))
        k = rnd.randrange(2)
        if a[k + 2] - a[k] > 1:
            c = rnd.randrange(a[k] + 1, a[k + 2])
            found += [(*a[:2], c, a[3]), (c, *a[1:])] if k == 0 else [(*a[:3], c), (a[0], c, *a[2:])]
        else:
            found.append(a)
    return [(i, *a) for i, a in enumerate(found)]


@pytest.mark.parametrize("seed", [1, 2])
def test_cut_lines_add_up_and_meet_on_borders(spark, seed):
    rnd = random.Random(seed)
    areas = tiles(rnd)
    frame = partition.areas_table(spark, areas)
    lines = {w: [(rnd.randrange(1000), rnd.randrange(1000)) if rnd.random() < 0.8 else (rnd.choice([a[1] for a in areas]) % 1000, rnd.choice([a[2] for a in areas]) % 1000) for _ in range(rnd.randint(1, 6))] for w in range(80)}
    points = spark.createDataFrame([(w, i, x, y) for w, line in lines.items() for i, (x, y) in enumerate(line)], "way_id long, seq int, lon_e7 long, lat_e7 long")
    cut = cutting.cut_segments(cutting.segments(points), frame, 400_000_000).collect()
    length = lambda a, b: abs(a[0] - b[0]) + abs(a[1] - b[1])
    by_id = {a[0]: a for a in areas}
    for w, line in lines.items():
        for i, (a, b) in enumerate(zip(line, line[1:], strict=False)):
            mine = sorted(((r.x1, r.y1), (r.x2, r.y2), r.tile_id) for r in cut if (r.way_id, r.seq) == (w, i))
            assert sum(length(p, q) for p, q, _ in mine) == length(a, b)  # exact, as pieces are monotone
            chain = sorted(mine, key=lambda m: (length(a, m[0]), length(a, m[1])))
            assert not chain or (chain[0][0] == a and chain[-1][1] == b and all(p[1] == q[0] for p, q in zip(chain, chain[1:], strict=False)))
            for p, q, t in mine:
                assert all(by_id[t][1] <= x <= by_id[t][3] and by_id[t][2] <= y <= by_id[t][4] for x, y in (p, q))
    pieces = cutting.cut_lines(points, frame, 400_000_000).collect()
    total = sum(length((p.x, p.y), (q.x, q.y)) for r in pieces for p, q in zip(r.points, r.points[1:], strict=False))
    assert total == sum(length(a, b) for line in lines.values() for a, b in zip(line, line[1:], strict=False))


def test_cut_rings_add_up(spark):
    rnd = random.Random(4)
    areas = tiles(rnd, n=9, span=1_000_000)
    frame = partition.areas_table(spark, areas)
    rings = {0: [(0, 0), (10**6, 0), (10**6, 10**6), (0, 10**6)], 1: [(100, 100), (900_000, 200_000), (500_000, 400_000), (800_000, 900_000), (50_000, 700_000)], 2: [(5, 5), (10, 5), (10, 9)], 3: [(7, 7), (8, 8), (9, 9)], 4: [(1, 1)]}
    made = spark.createDataFrame([(i, r) for i, r in rings.items()], "id long, ring array<struct<x: long, y: long>>")
    cut = cutting.cut_rings(made, frame, 400_000_000)
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True))
    got = cut.withColumn("a", cutting.double_area(F.col("ring"))).collect()
    by_id = {a[0]: a for a in areas}
    for r in got:
        ring = [(p.x, p.y) for p in r.ring]
        assert int(r.a) == area(ring)
        assert all(by_id[r.tile_id][1] <= x <= by_id[r.tile_id][3] and by_id[r.tile_id][2] <= y <= by_id[r.tile_id][4] for x, y in ring)
    for i in (0, 1, 2):
        parts = [int(r.a) for r in got if r.id == i]
        assert abs(sum(parts) - area(rings[i])) <= 4_000_000 * (i == 1)  # border points are rounded to a unit
    assert {r.id for r in got} == {0, 1, 2} and len([r for r in got if r.id == 0]) == len(areas)


def test_clip_tests_stay_out_of_the_join(spark, tmp_path):
    """Written out within the join's condition, the fractions were computed for every pair of a cell, and too long to be compiled."""
    points = spark.createDataFrame([(1, i, x, y) for i, (x, y) in enumerate([(0, 0), (900, 300), (20, 700)])], "way_id long, seq int, lon_e7 long, lat_e7 long")
    points.write.parquet(f"{tmp_path}/points")
    areas = partition.areas_table(spark, [(1, 0, 0, 500, 1000), (2, 500, 0, 1000, 1000)])
    cut = cutting.cut_segments(cutting.segments(spark.read.parquet(f"{tmp_path}/points")), areas, 400_000_000)
    joins = [line for line in cut._jdf.queryExecution().executedPlan().toString().splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
    assert len(joins) == 1 and "BroadcastHashJoin" in joins[0] and "CASE WHEN" not in joins[0]
    assert sorted((r.seq, r.tile_id) for r in cut.collect()) == [(0, 1), (0, 2), (1, 1), (1, 2)]
