"""Nearest places against all pairs, where places lie close together, far apart and at one spot."""

import random

from terrane.operators import partition


def test_nearest_place_and_the_first_grid(spark, monkeypatch):
    r = random.Random(6)
    spots = [(r.randrange(-900, 900) * 10**6, r.randrange(-1800, 1800) * 10**6) for _ in range(20)]
    crowd = [(500_000_000 + r.randrange(10**6), 700_000_000 + r.randrange(10**6)) for _ in range(300)]
    places = [(f"p{i % 310}", *s) for i, s in enumerate(spots + crowd)] + [("a", *spots[0]), ("b", *spots[0])]
    points = [(i, r.randrange(-900, 900) * 10**6, r.randrange(-1800, 1800) * 10**6) for i in range(60)]
    points += [(60 + i, 500_000_000 + r.randrange(10**6), 700_000_000 + r.randrange(10**6)) for i in range(60)]
    frame = spark.createDataFrame(places, "name string, lat_e7 long, lon_e7 long")
    plans, run = [], partition.checkpointed
    monkeypatch.setattr(partition, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or run(df))
    got = dict(map(tuple, partition.nearest(spark.createDataFrame(points, "id long, lat_e7 long, lon_e7 long"), frame, "id", "name").collect()))
    assert got == {i: min((float(x - px) * (x - px) + float(y - py) * (y - py), n) for n, py, px in places)[1] for i, y, x in points}
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)
    apart = frame.selectExpr("lat_e7 AS p_lat", "lon_e7 AS p_lon")
    assert partition.crowding(apart) < 10**6 < partition.crowding(apart.limit(20))  # a fixed grid of 4 degrees put the crowd in one cell
