"""Rectilinear polygons are filled exactly by rectangles and tiles."""

import random

import pytest

from terrane import queries
from terrane.operators import partition, regions

HOLED = [(0, 0), (9, 0), (9, 7), (6, 7), (6, 3), (3, 3), (3, 7), (0, 7)]


def area(ring):
    return abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True))) // 2


def skyline(rng, columns):
    """A rectilinear ring of random towers on a common floor."""
    x, ring = 0, [(0, -5)]
    for _ in range(columns):
        y, step = rng.randint(0, 30), rng.randint(1, 9)
        ring += [(x, y), (x + step, y)]
        x += step
    return [*ring, (x, -5)]


@pytest.mark.parametrize("ring", [HOLED, queries.STEPPED, *[skyline(random.Random(i), i + 1) for i in range(18)]])
def test_rectangles_fill_the_ring(ring):
    boxes = partition.rectangles(ring)
    assert sum((r - a) * (t - b) for a, b, r, t in boxes) == area(ring)
    assert not any(p[0] < q[2] and q[0] < p[2] and p[1] < q[3] and q[1] < p[3] for i, p in enumerate(boxes) for q in boxes[:i])
    assert partition.rectangles([*ring, ring[0]]) == boxes


def test_other_rings_are_not_fitted():
    assert partition.rectangles([(0, 0), (5, 5), (0, 5)]) is None
    assert partition.rectangles(skyline(random.Random(1), 20)) is None  # 42 corners
    assert partition.rectangles([]) is None


def test_tiles_fill_their_boxes_and_hold_few_nodes(spark):
    rng = random.Random(4)
    nodes = [(rng.randint(-300, 900), rng.randint(-300, 900)) for _ in range(3000)] + [(5, 5)] * 50
    boxes = [(-295, -290, 101, 403), (101, -290, 805, 55), (2000, 2000, 2107, 2011)]
    df = spark.createDataFrame(nodes, "lat_e7 long, lon_e7 long")
    got = partition.fit(df, boxes, 40, 10).collect()
    for i, (left, bottom, right, top) in enumerate(boxes, 1):
        tiles = [r for r in got if r.box == i]
        assert sum((r.right - r.left) * (r.top - r.bottom) for r in tiles) == (right - left) * (top - bottom)
        assert all(left <= r.left < r.right <= right and bottom <= r.bottom < r.top <= top for r in tiles)
        assert not any(p.left < q.right and q.left < p.right and p.bottom < q.top and q.bottom < p.top for k, p in enumerate(tiles) for q in tiles[:k])
        for r in tiles:
            assert r.n == sum(r.left <= x < r.right and r.bottom <= y < r.top for y, x in nodes)
            assert r.n <= 40 or (r.right - r.left <= 10 and r.top - r.bottom <= 10)
    assert [(r.n, r.left, r.top) for r in got if r.box == 3] == [(0, 2000, 2011)]


def test_mask_of_nothing(spark):
    empty = spark.createDataFrame([], "cx int, cy int, n long")
    assert partition.mask(empty, regions.ring_table(spark, [queries.STEPPED]), 100_000_000).count() == 0
    assert partition.mask(spark.createDataFrame([(1, 1, 3)], "cx int, cy int, n long"), regions.ring_table(spark, []), 100_000_000).count() == 0
