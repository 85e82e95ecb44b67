"""Deltas by transaction ids: every change comes out once, in the first delta that sees it, late ones too."""

import random

from terrane.streaming import transactions as tx


def logged(spark, n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        began = i // 20
        rows.append((i, began, None if rng.random() < 0.02 else began + rng.choice((0, 0, 0, 1, 2, 9))))
    return rows, spark.createDataFrame(rows, "txid long, began long, ended long")


def test_stream_sends_each_change_once_and_in_the_first_delta_that_sees_it(spark, tmp_path):
    rows, df = logged(spark)
    last = max(max(b, e or 0) for _, b, e in rows)
    snaps = tx.snapshots_of(df, "txid", "began", "ended")
    changes = df.select("txid", "began").union(df.where("txid % 7 = 0").select("txid", "began"))  # transactions of two changes
    want = sorted((i, e) for i, _, e in rows if e is not None for _ in range(2 if i % 7 == 0 else 1))
    for k, (lo, hi) in enumerate([(0, 3), (4, 4), (5, last)]):  # snapshots arrive bit by bit, the stream goes on where it was
        snaps.where(f"sequence between {lo} and {hi}").coalesce(1).write.mode("append").parquet(str(tmp_path / "snaps"))
        got = tx.replicate(spark, changes, str(tmp_path / "snaps"), str(tmp_path / "out"), str(tmp_path / "cp"), "txid", most_files=1)
        assert sorted((r.txid, r.sequence) for r in got.collect()) == [x for x in want if x[1] <= hi], k


def test_open_null_and_empty(spark):
    _, df = logged(spark, 60)
    snaps = spark.createDataFrame([(1, 10, [3, 4]), (2, 10, [4]), (3, 20, None)], tx.SNAPSHOT)
    odd = spark.createDataFrame([(3, "late"), (4, "later"), (9, "first"), (19, "third"), (20, "not yet"), (None, "none")], "txid long, sequence string")
    assert sorted((r.txid, r.sequence) for r in tx.first_seen(odd, snaps, "txid").collect()) == [(3, 2), (4, 3), (9, 1), (19, 3)]
    before = snaps.where("sequence = 1").first()
    assert sorted((r.txid, r.sequence) for r in tx.first_seen(odd, snaps.where("sequence > 1"), "txid", before).collect()) == [(3, 2), (4, 3), (19, 3)]
    assert tx.first_seen(df.limit(0), snaps, "txid").count() == 0
    assert tx.first_seen(df, snaps.limit(0), "txid").count() == 0
