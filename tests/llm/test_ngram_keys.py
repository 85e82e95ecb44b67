"""Sketches and names of keys: what they drop is never linked, nor does it occur twice."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("xxhash")
from terrane.llm import ngram_join as nj  # noqa: E402


def test_sketches_bound_the_differences_of_long_rows():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 20000).astype(nj.U)
    for x, y in ((3000, 3000), (3000, 2500), (40, 37), (300, 700), (1, 1)):
        for shared in {0, min(x, y) // 2, min(x, y)}:
            a, b = np.unique(pool[:x]), np.unique(pool[x - shared : x - shared + y])
            apart = len(np.setxor1d(a, b))
            for p, q in ((a, b), (b, a)):
                assert nj.bits_apart(nj.sketch(p), nj.sketch(q)) <= apart
            assert nj.bits_apart(nj.sketch(a), nj.sketch(a)) == 0
    # half of 3000 entries shared: 512 bits are full and say nothing, the sketch tells the rows apart
    a, b = np.sort(pool[:3000]), np.sort(pool[1500:4500])
    full = sum(int(np.bitwise_count(u ^ v)) for u, v in zip(*nj.parities([a, b]).view(nj.U), strict=True))
    assert full * 180 <= 6000 * 20 < nj.bits_apart(nj.sketch(a), nj.sketch(b)) * 180


@pytest.mark.parametrize("held", [1, 50, 1 << 21])
def test_names_that_occur_twice_are_found_whatever_a_task_holds(monkeypatch, held):
    monkeypatch.setattr(nj, "HELD", held)
    rng = np.random.default_rng(6)
    keys = rng.integers(0, nj.NAMES, 3000).astype(nj.U)
    keys = rng.permutation(np.concatenate([keys, keys[:200], keys[:20]]))
    slots = [(int(s), np.sort(keys[keys >> nj.U(32) == s]).astype(np.uint32)) for s in np.unique(keys >> nj.U(32))]
    rows = [(s, part.tobytes()) for s, names in slots for part in np.array_split(names, 2)]
    batches = [pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows[i : i + 7]]), pa.array([b for _, b in rows[i : i + 7]], pa.binary())], ["slot", "names"]) for i in range(0, len(rows), 7)]
    got = np.concatenate([b.column(0).to_numpy() for b in nj._repeated(iter(batches))])
    values, n = np.unique(keys, return_counts=True)
    assert np.array_equal(np.sort(got).astype(nj.U), values[n > 1])
