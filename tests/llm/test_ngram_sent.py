"""No join of the n-gram join is a broadcast by an estimate: files of many alike rows are small, their rows are not."""

import random

import pytest

pytest.importorskip("xxhash")
from test_ngram_groups import check, near_copies  # noqa: E402

from terrane.llm import _graph, ngram_join as nj  # noqa: E402


def test_joins_by_rows_that_grow_are_merges(spark, monkeypatch):
    plans, plain, plain_written = [], nj.stored, _graph.written

    def noted(df, name, write):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(nj, "stored", lambda df, name: noted(df, name, plain))
    monkeypatch.setattr(_graph, "written", lambda df, name: noted(df, name, plain_written))
    monkeypatch.setattr(_graph, "AT_ONCE", 8)  # rounds of stars
    monkeypatch.setattr(nj, "FEW", 8)  # rounds of centres
    monkeypatch.setattr(nj, "ROUNDS", 1)
    monkeypatch.setattr(nj, "MOST_SENT", 0, raising=False)
    rng = random.Random(7)
    texts = []
    for variant in near_copies(rng, [f"w{i}" for i in range(40)], 2, (1, 2, 3)):
        texts += near_copies(rng, variant.split(), 12, (0, 1, 2, 3))
    check(spark, texts, 2, 90, 100)
    scans = [(name, line) for name, plan in plans for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert {"ngram-cells", "ngram-pairs", "ngram-links", "ngram-stars", "edges"} <= {name for name, _ in plans}
    assert [x for x in scans if x[0] in ("ngram-cells", "ngram-pairs", "ngram-links", "ngram-stars", "edges")] == []
