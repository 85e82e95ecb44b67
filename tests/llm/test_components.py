"""Components of few edges take one task, those of many take rounds; both are whole, and a join of few rows runs few tasks."""

import random

import pytest
from test_ngram_groups import near_copies
from test_ngram_join import brute

from terrane.llm import _graph
from terrane.llm import ngram_join as nj


def tasks_of(spark, name, run):
    """What ``run`` returns, and the tasks that it took."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds}
    return out, sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))


def union_find(edges):
    up = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in up and b in up and up[a] != up[b]:
                up[a] = up[b] = min(up[a], up[b])
                changed = True
    return up


@pytest.mark.parametrize("at_once", [0, 299, 300, 1 << 14])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_whatever_one_task_takes(spark, monkeypatch, at_once, kind):
    monkeypatch.setattr(_graph, "AT_ONCE", at_once)
    rng = random.Random(3)
    ids = [f"é{i}" if kind == "string" else i - 200 for i in range(400)]
    edges = [tuple(rng.sample(ids, 2)) for _ in range(180)] + [(ids[0], x) for x in ids[300:360]] + list(zip(ids[200:240], ids[201:241], strict=True))
    edges += edges[:20]  # 300 edges, some of them twice
    loose = [(None, ids[0]), (ids[1], None), (ids[399], ids[399])]
    got = _graph.components(spark.createDataFrame(edges + loose, f"a {kind}, b {kind}")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.comp for r in got} == union_find(edges + loose)


def test_no_edges(spark):
    assert _graph.components(spark.createDataFrame([], "a string, b string")).collect() == []


def test_few_edges_take_few_tasks(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").coalesce(1)
    got, tasks = tasks_of(spark, "few-edges", lambda: _graph.components(edges))
    assert {r.comp for r in got.collect()} == {0}
    assert tasks <= 20  # a round of stars alone takes more


def test_a_round_of_centres_takes_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(nj, "FEW", 16)
    rng = random.Random(8)
    texts = near_copies(rng, [f"w{i}" for i in range(90)], 120, (0, 1, 2, 3, 4))
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(4)
    got, tasks = tasks_of(spark, "centres", lambda: nj.link_documents(frame, 3, 90, 100).collect())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(zip((d for d, _ in docs), brute(docs, 3, 90, 100), strict=True))
    assert tasks <= 290
