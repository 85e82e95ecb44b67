"""Shards with fewer kept words than the longest benchmark item."""

import numpy as np

from terrane.llm import decontam

ITEM = [f"w{i}" for i in range(59)]


def test_two_short_documents_against_a_long_item(spark):
    texts = [" ".join(ITEM[:11]), " ".join(ITEM[30:41])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([("a", " ".join(ITEM))], "item_id string, text string")
    got = {r.doc_id: r for r in decontam.find_contamination(docs, bench).collect()}
    assert [(got[i].n_words, got[i].n_hit, got[i].longest_match, got[i]["items"]) for i in (0, 1)] == [(11, 11, 11, ["a"])] * 2


def test_suffix_array_of_any_length_below_the_depth():
    rng = np.random.default_rng(3)
    for n in range(65):
        codes = rng.integers(0, 3, n).astype(np.int32)
        codes[-1:] = 0
        order = decontam.suffix_array(codes, 60)
        run = lambda i: codes[i : i + int(np.argmax(codes[i:] == 0)) + 1].tolist()
        found = [run(i) for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(n)) and found == sorted(found)
