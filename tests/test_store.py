"""The merge-on-read store: what a batch writes, late and repeated batches, snapshots, compaction and two writers."""

from __future__ import annotations

import random
from datetime import datetime
from pathlib import Path

from terrane.streaming.store import Store, _with, _within

SCHEMA = "id long, version int, action string, ts timestamp_ntz, v string"
T = datetime(2024, 1, 1)


def made(spark, tmp_path, **more):
    return Store(spark, str(tmp_path / "store"), "id long, version int, ts timestamp_ntz, v string", **more)


def size(path: Path) -> int:
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def rows(df):
    return sorted((r.id, r.version, r.v) for r in df.collect())


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    store = made(spark, tmp_path, buckets=4)
    first = spark.range(20_000).selectExpr("id", "1 AS version", "'create' AS action", "timestamp_ntz'2024-01-01' AS ts", "uuid() AS v")
    store.apply(first, 0)
    top = tmp_path / "store"
    before = size(top)
    store.apply(spark.createDataFrame([(i, 2, "modify", T, "new") for i in range(40)], SCHEMA), 1)
    assert size(top) - before < before / 50
    assert store.manifest()["deltas"] and store.read().count() == 20_000 and store.read().where("v = 'new'").count() == 40
    store.apply(first.where("id < 15000").selectExpr("id", "3 AS version", "'delete' AS action", "ts", "v"), 2)
    assert not store.manifest()["deltas"]  # so much has changed that every bucket was compacted
    assert store.read().count() == 5000 and store.vacuum() >= 2 and store.read().count() == 5000
    assert size(top) < 2 * before


def test_any_order_of_batches_gives_the_same(spark, tmp_path):
    rnd = random.Random(3)
    changes = {(rnd.randrange(30), v): rnd.choice(["modify", "modify", "delete"]) for v in range(1, 60)}
    batches = [[] for _ in range(5)]
    for (i, v), action in changes.items():
        batches[rnd.randrange(5)].append((i, v, action, T, f"{i}.{v}"))
    last = {i: max(v for j, v in changes if j == i) for i, _ in changes}
    want = sorted((i, v, f"{i}.{v}") for i, v in last.items() if changes[i, v] != "delete")
    for k, order in enumerate(([0, 1, 2, 3, 4], [4, 2, 2, 0, 3, 1, 4])):
        store = made(spark, tmp_path / str(k), buckets=3, compact_at=0.5 + 2 * k)
        for n in order:
            store.apply(spark.createDataFrame(batches[n], SCHEMA), n)
        assert rows(store.read()) == want
        store.compact(at=0)
        assert rows(store.read()) == want and not store.manifest()["deltas"] and store.manifest()["sequences"] == [[0, 4]]


def test_snapshots_hook_and_empty_batches(spark, tmp_path):
    store, seen = made(spark, tmp_path), []
    store.apply(spark.createDataFrame([], SCHEMA), 7)
    assert store.read().count() == 0 and store.manifest()["sequences"] == [[7, 7]]
    store.apply(spark.createDataFrame([(1, 5, "create", T, "a"), (1, 4, "create", T, "old"), (2, 1, "create", T, None)], SCHEMA), 8)
    at = store.snapshots()[-1]
    store.apply(spark.createDataFrame([(1, 5, "modify", T, "same version"), (2, 2, "delete", T, None), (3, 1, "create", T, "c")], SCHEMA), 9, hook=lambda df: seen.extend(sorted(r.id for r in df.collect())))
    assert seen == [2, 3] and rows(store.read()) == [(1, 5, "a"), (3, 1, "c")] and rows(store.read(at)) == [(1, 5, "a"), (2, 1, None)]


def test_of_two_writers_both_are_in(spark, tmp_path):
    one, two = made(spark, tmp_path, compact_at=1e9), made(spark, tmp_path, compact_at=1e9)
    commit = one._commit

    def late(change):
        if not two.manifest()["sequences"]:  # the other writer commits between this one's look and its rename
            two.apply(spark.createDataFrame([(2, 1, "create", T, "two")], SCHEMA), 1)
        return commit(change)

    one._commit = late
    stale = one.manifest()
    one.manifest = lambda snapshot=None, real=one.manifest, first=[stale]: first.pop() if first and two.manifest()["sequences"] else real(snapshot)
    one.apply(spark.createDataFrame([(1, 1, "create", T, "one")], SCHEMA), 0)
    assert rows(two.read()) == [(1, 1, "one"), (2, 1, "two")] and two.manifest()["sequences"] == [[0, 1]]


def test_ranges():
    assert _with(3, [[0, 2], [4, 5]]) == [[0, 5]] and _with(9, [[0, 2]]) == [[0, 2], [9, 9]] and _within(1, [[0, 2]]) and not _within(3, [[0, 2], [4, 4]])
