import math
import random

import numpy as np

from terrane.llm.topk import LEVELS, segments, top_k


def brute(rows, queries, k):
    def ints(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v]

    rows = [(i, ints(v)) for i, v in rows]
    out = []
    for q, v in ((i, ints(v)) for i, v in queries):
        if q is None or v is None:
            continue
        scored = [(-sum(a * b for a, b in zip(v, c)), i) for i, c in rows if i is not None and c is not None and i != q and len(c) == len(v)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(20)]) for i in range(300)]
    rows += [(300 + i, list(rows[i % 7][1])) for i in range(40)]  # ties
    rows += [(400, None), (401, [None] * 20), (402, [math.nan] * 20), (403, [math.inf] * 20), (404, [0.5] * 3), (405, [0.25] * 3), (406, []), (None, rows[0][1])]
    rows += [(50, list(rows[50][1])), (51, [3e3] * 20)]  # repeated ids
    schema = "vec_id long, embedding array<double>, rank string"
    frame = spark.createDataFrame([(i, v, "clash") for i, v in rows], schema)
    queries = [r for r in rows if r[0] is not None and r[0] % 25 in (0, 5)]
    got = top_k(frame, spark.createDataFrame([(i, v, "") for i, v in queries], schema), block_rows=64).collect()
    assert sorted(map(tuple, got)) == brute(rows, queries, 5)
    assert top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(0)
    q, c = rng.integers(-200, 200, (2, 50, 37)).astype(float)
    last = np.full((50, 50), np.inf)
    for k in LEVELS:
        bound = segments(q, k) @ segments(c, k).T
        assert (bound >= q @ c.T - 1e-6).all()
        assert bound.mean() <= last.mean()
        last = bound
