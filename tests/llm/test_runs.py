"""Runs against trying every period, and range minima against slices."""

from __future__ import annotations

import random

import numpy as np
import pytest

from terrane.llm import runs
from terrane.llm._rmq import RangeMin, next_smaller, previous_smaller


def plain_runs(words: list, least: int) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words: list[str], least: int) -> str:
    gone = {i for s, n, q in plain_runs(words, least) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(rnd: random.Random, letters: int, longest: int) -> list[int]:
    out = [rnd.randrange(letters) for _ in range(rnd.randint(0, longest))]
    return out + out[-rnd.randint(1, len(out)) :] * rnd.randint(1, 5) if out and rnd.random() < 0.5 else out


@pytest.mark.parametrize("least", [2, 3, 5, 6, 12])
def test_all_runs_are_found(least):
    rnd = random.Random(least)
    for _ in range(150):
        texts = [made(rnd, rnd.choice([1, 2, 3, 6]), 50) for _ in range(rnd.randint(1, 5))]
        found = runs.runs_of([np.array(t, np.int64) for t in texts], least)
        assert [[tuple(r) for r in x.tolist()] for x in found] == [plain_runs(t, least) for t in texts]


def test_long_periodic_sequences():
    a, b = [1], [1, 2]
    while len(b) < 1500:
        a, b = b, b + a  # Fibonacci words have as many runs as words can have, about
    for words in (b, [7] * 3000, [1, 2, 3, 4, 5] * 500 + [9] + [1, 2] * 300):
        assert [tuple(r) for r in runs.runs_of([np.array(words)])[0].tolist()] == plain_runs(words, 12)
    assert runs.runs_of([np.zeros(300_000, np.int64)])[0].tolist() == [[0, 300_000, 1]]


def test_range_minima_and_nearest_smaller():
    rnd = random.Random(3)
    for n in (0, 1, 2, 15, 16, 17, 300, 2000):
        v = np.array([rnd.randrange(1 + n // rnd.choice([1, 3, 50])) for _ in range(n)], np.int64)
        right, left = next_smaller(v), previous_smaller(v)
        for i in range(n):
            after = np.flatnonzero(v[i + 1 :] < v[i])
            before = np.flatnonzero(v[:i] < v[i])
            assert right[i] == (i + 1 + after[0] if len(after) else n) and left[i] == (before[-1] if len(before) else -1)
        if n:
            lo = np.array([rnd.randrange(n) for _ in range(300)])
            hi = np.array([rnd.randrange(i, n) for i in lo])
            assert RangeMin(v).least(lo, hi).tolist() == [v[i : j + 1].min() for i, j in zip(lo, hi, strict=True)]


def test_texts_nulls_ties_and_other_columns(spark):
    chorus = "la la la la la la la la la la la la end"
    given = [(1, chorus, "x"), (1, chorus, "x"), (2, None, "x"), (3, "", "x"), (None, " \t\n ", "x"), (4, "a b\tc\n" * 5 + "d", "x"), (5, "Ä b " * 12, "x"), (6, "one two", "x"), (7, "x y z " * 40_000, "x")]
    found = runs.find_runs(spark.createDataFrame(given, "id long, body string, runs string"), id_col="id", text_col="body")
    rows = sorted((tuple(r) for r in found.collect()), key=str)
    assert len(rows) == len(given) and found.columns == ["doc_id", "n_words", "runs", "text"]
    for (i, text, _), (doc, n, got, kept) in zip(sorted(given, key=lambda g: str((g[0], len((g[1] or "").encode().split())))), sorted(rows, key=lambda r: str(r[:2])), strict=True):
        words = [w.decode() for w in (text or "").encode().split()]
        assert (doc, n) == (i, len(words))
        assert [tuple(r) for r in got] == ([(0, 120_000, 3)] if i == 7 else plain_runs(words, 12))
        assert kept == ("x y z" if i == 7 else plain_collapsed(words, 12))
    assert runs.find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
