import re
from collections import Counter

import numpy as np
import pytest

from terrane.llm.line_dedup import LineIndex, dedup_lines


def brute(rows, min_docs, min_chars):
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    often = Counter(k for t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or often[key(x)] < min_docs]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("min_docs,min_chars", [(3, 1), (2, 4), (10, 1)])
def test_against_brute_force(spark, min_docs, min_chars):
    base = ["Same line\nown a\n\n", "  SAME LINE \nown b", "same line\t\nÉtat\n", "état\nÉTAT", None, "", "\n\n", "x" * 200_000 + "\nsame line", "same line\nown a\n\n"]
    texts = base + [f"own {i}\nmenu | home\n éa " for i in range(12)] + ["\x1cmenu | home\r\n menu | home"]
    rows = [(i if i != 3 else None, t, "clash", i) for i, t in enumerate(texts)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_dropped string, shard int"), min_docs=min_docs, min_chars=min_chars).collect()
    want = brute(texts, min_docs, min_chars)
    assert sorted((r.shard, r.text, r.n_lines, r.n_dropped) for r in got) == [(i, *w) for i, w in enumerate(want)]


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_index_is_minimal_and_exact():
    rng = np.random.default_rng(1)
    hi, lo = rng.integers(-(2**63), 2**63 - 1, (2, 30_000))
    n = rng.integers(1, 70_000, 30_000)
    index = LineIndex.load(LineIndex.build(hi, lo, n).dump())
    assert sorted(index.slots(hi.view(np.uint64), lo.view(np.uint64))) == list(range(30_000))
    assert (index.count(hi, lo) == n).all() and index.counts.dtype == np.uint32
    assert not index.count(lo, hi).any()  # keys that the index does not hold
    empty = LineIndex.load(LineIndex.build(hi[:0], lo[:0], n[:0]).dump())
    assert not empty.count(hi, lo).any()
