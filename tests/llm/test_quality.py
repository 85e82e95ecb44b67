import random
import zlib

import numpy as np

from terrane.llm import quality as q


def corpus(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < 0.3
        if bad:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w + " |" for w in words]
        out.append((i, " ".join(words) + ".", 0 if bad else 1))
    return out


def test_held_out_accuracy_and_defined_cases(spark):
    rows = corpus(600)
    odd = [(1000, None), (1001, ""), (1002, "X" * 300_000), (None, "an id is null here"), (7, rows[7][1]), (7, rows[7][1])]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows] + [(i, t, None) for i, t in odd], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (3, None, 1), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    model = q.train(docs, labels)
    got = q.score_quality(docs, model).collect()
    assert len(got) == len(rows) + len(odd) and set(got[0].asDict()) == {"doc_id", "text", "score", "predicted"}
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    empty = {r.score for r in got if r.doc_id in (1000, 1001)}
    assert len(empty) == 1 and q.score_quality(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert q.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) is None
    assert q.score_quality(docs, None).first().score == 0.5


def test_a_pair_explains_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    alone = q.fit(x, y, pairs=0)
    both = q.fit(x, y, pairs=1)
    assert both.pairs == [(1, 0)] and ((both.score(x) > 0.5) == y).mean() > 0.9 > ((alone.score(x) > 0.5) == y).mean() + 0.2


def test_tree_cuts_where_the_gradients_change():
    g = np.array([-5.0] * 4 + [3.0] * 6 + [0.0] * 2)
    values = q._tree(g, np.ones(12), 3, 0.0)
    assert np.allclose(values, g)
