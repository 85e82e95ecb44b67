"""What the n-gram join stores: short sets of all rows, and only the keys that rows share, however many they are."""

import random
from pathlib import Path

import pytest

pytest.importorskip("xxhash")
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from test_ngram_join import brute  # noqa: E402

from terrane.llm import _sieve, ngram_join as nj  # noqa: E402


def prose(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_sets_are_stored_short_and_keys_that_meet_none_are_not(spark, monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, rng.choice((200, 300))) for _ in range(150)]
    for i in range(0, 40, 4):
        copy = list(texts[i])
        copy[rng.randrange(100)] = "changed"
        texts += [copy, texts[i]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(3, "w1 w2"), (3, "w1 w2"), (None, "w1 w2"), (None, None)]
    seen, plain = {}, nj.written

    def written(df, name):
        out, path = plain(df, name)
        size = sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("*.parquet"))
        seen.setdefault(name, (size, out.count()))
        return out, path

    monkeypatch.setattr(nj, "written", written)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = sorted(zip([d for d, _ in docs], brute(docs, 3, 80, 100), strict=True), key=str)
    entries = []
    for bits in (27, 6):  # a table of 64 bits lets all pass
        monkeypatch.setattr(_sieve, "MOST_BITS", bits)
        monkeypatch.setattr(nj, "LEAST_SENT", 1 << bits)
        seen.clear()
        got = nj.link_documents(frame, 3, 80, 100).collect()
        assert sorted(((r.doc_id, (r.n_shingles, r.component_id)) for r in got), key=str) == want
        assert seen["ngram-rows"][0] < 7 * sum(n for _, (n, _) in want)  # 8 bytes an entry would be whole hashes
        entries.append(seen["ngram-entries"][1])
    assert 0 < entries[0] <= entries[1] < 2 * entries[0]


def test_rows_of_shared_names(monkeypatch):
    rng = np.random.default_rng(9)
    names = [rng.integers(0, nj.NAMES, 40).astype(nj.U) for _ in range(30)]
    for i in range(5, 30):
        names[i][: i // 2] = names[i % 5][: i // 2]
    names[7][1] = names[7][0]
    tags = [int(t) << (33 * (i % 2)) for i, t in enumerate(rng.integers(0, 5000, 30))]
    monkeypatch.setattr(nj, "block_keys", lambda sets, num, den: [names[int(s[0] >> nj.U(24))] for s in sets])
    blobs = [nj.shortened(np.array([i << 24], nj.U)) for i in range(30)]
    table = type("Table", (), {"value": np.full(1, -1, np.int64)})
    batches = [pa.RecordBatch.from_arrays([pa.array(tags[i : i + 9]), pa.array(tags[i : i + 9]), pa.array(blobs[i : i + 9], pa.binary())], ["tag", "slot", "short"]) for i in range(0, 30, 9)]
    want = {}
    for t, mine in zip(tags, names, strict=True):
        for x in mine.tolist():
            want.setdefault(x, set()).add(t)
    want = {(x, t, min(ts)) for x, ts in want.items() for t in ts if len(ts) > 1}
    for held in (1, 300, 1 << 21):
        monkeypatch.setattr(nj, "HELD", held)
        rows = sorted(r for b in nj._dealt_keys(80, 100, table)(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary())
        dealt = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 50], strict=True), kinds, strict=True)], ["slot", "names", "first", "steps"]) for i in range(0, len(rows), 50)]
        got = [r for b in nj._repeated(iter(dealt)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert len(got) == len(want) and set(got) == want


def test_shortened_sets_keep_their_sizes_and_what_they_share():
    rng = np.random.default_rng(10)
    x = np.unique(rng.integers(0, 2**64, 500, dtype=nj.U))
    y = np.unique(np.append(x[20:], x[:3] + nj.U(1)))  # three entries that only the left-out bits tell apart
    short = [nj.lengthened(nj.shortened(s)) for s in (x, y)]
    assert [len(s) for s in short] == [len(x), len(y)] and np.array_equal(short[0], x >> nj.U(24) << nj.U(24))
    assert nj.shortened(np.empty(0, nj.U)) == b"" and len(nj.lengthened(b"")) == 0
