"""Links at thresholds that span more than two size classes."""

import random

import pytest

from terrane.llm import ngram_join as nj

from test_ngram_join import brute


@pytest.mark.parametrize("num", [50, 20])
def test_low_thresholds_against_brute_force(spark, num):
    rng = random.Random(11)
    docs = [(0, " ".join(f"a{i}" for i in range(7))), (1, " ".join(f"a{i}" for i in range(12)))]
    for k, size in enumerate((5, 9, 20, 41, 80)):
        words = [f"b{k}x{i}" for i in range(size)]
        for part in (1.0, 0.6, 0.5, 0.3, 0.2):
            docs.append((len(docs), " ".join(rng.sample(words, max(1, int(size * part))))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.link_documents(frame, 1, num, 100).collect()}
    assert got == dict(zip((d for d, _ in docs), brute(docs, 1, num, 100), strict=True))
    assert got[1][1] == 0
