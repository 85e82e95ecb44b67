"""Large groups of near copies that do not link with the row that stands for them."""

import random

from test_ngram_join import brute

from terrane.llm import ngram_join as nj


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice(edits)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def check(spark, texts, n, num, den):
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.link_documents(frame, n, num, den).collect()}
    assert got == dict(zip((d for d, _ in docs), brute(docs, n, num, den), strict=True))
    return got


def test_500_near_copies_apart_from_the_least(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = near_copies(rng, base, 500, (0, 1, 2, 3, 4, 6))
    got = check(spark, texts, 3, 90, 100)
    assert len({c for _, c in got.values()}) > 1


def test_families_within_a_family(spark, monkeypatch):
    monkeypatch.setattr(nj, "FEW", 8)  # many rounds of centres
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for variant in near_copies(rng, base, 6, (1, 2, 3)):
        texts += near_copies(rng, variant.split(), 25, (0, 1, 2, 3))
    check(spark, texts, 2, 90, 100)
    monkeypatch.setattr(nj, "ROUNDS", 1)  # what is left is compared directly
    check(spark, texts, 2, 80, 100)


def test_differences():
    import numpy as np

    p, r = np.array([1, 3, 5, 7], nj.U), np.array([1, 2, 5, 9], nj.U)
    assert (nj.differences(p, r, 1, 100)[0], nj.differences(p, r, 1, 100)[1].tolist()) == (4, [2, 9, 3, 7])
    assert nj.differences(p, r, 90, 100)[1].tolist() == [2]
    assert nj.differences(p, p, 90, 100)[0] == 0
