"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from terrane.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def plain(convs: dict[int, list[tuple[str, int]]]) -> list[tuple]:
    """Rows of the trie; convs: turns as (text, words) by id."""
    nodes: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children: dict[tuple, list[tuple]] = {k: [] for k in nodes}
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    out = []
    for k, members in nodes.items():
        below = [x for x in nodes if x[: len(k)] == k]
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(k))
        saved = sum((len(nodes[x]) - 1) * x[-1][1] for x in below if x)
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(children[k]), sum(not children[x] for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(convs: dict[int, list[str]]) -> list[tuple]:
    return [(c, i, "user", t, "x") for c, turns in convs.items() for i, t in enumerate(turns)]


def found(spark, convs: dict[int, list[str]], block_turns: int) -> list[tuple]:
    turns = prefix_trie.conversation_turns(spark.createDataFrame(rows_of(convs), SCHEMA))
    return rows(prefix_trie.prefix_trie(turns, block_turns))


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*prefix_trie.NODE).collect()), key=str)


@pytest.mark.parametrize(("seed", "block_turns"), [(1, 1 << 14), (2, 40), (3, 12), (4, 5)])
def test_equal_to_a_dictionary_of_prefixes(spark, seed, block_turns):
    rnd = random.Random(seed)
    convs: dict[int, list[str]] = {}
    for c in rnd.sample(range(-50, 1000), 60):
        convs[c] = [rnd.choice(["a b", "c", "d e f", "a  b "]) for _ in range(rnd.randint(1, 6))]
        if rnd.random() < 0.4 and len(convs) > 1:
            convs[c] = list(rnd.choice(list(convs.values())))[: rnd.randint(1, 6)]
    assert found(spark, convs, block_turns) == plain({c: [(t, len(t.split())) for t in x] for c, x in convs.items()})


@pytest.mark.parametrize("block_turns", [7, 1 << 14])
def test_many_copies_and_a_long_conversation_over_many_blocks(spark, block_turns):
    convs = {c: ["same one", "same two"] for c in range(40)}
    convs |= {100 + c: ["same one", "same two", f"own {c % 3}"] for c in range(20)}
    convs[200] = ["same one", *[f"t {i}" for i in range(300)]]
    convs[201] = [*convs[200][:250], "other"]
    assert found(spark, convs, block_turns) == plain({c: [(t, len(t.split())) for t in x] for c, x in convs.items()})


def test_empty_null_and_repeated(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rows(prefix_trie.prefix_trie(prefix_trie.conversation_turns(none))) == []
    given = [(1, None, None, None, "x"), (1, 1, "user", "hi", "x"), (1, 1, "user", "hi", "x"), (None, 1, "user", "lost", "x"), (2, 5, "", "", "x")]
    turns = prefix_trie.conversation_turns(spark.createDataFrame(given, SCHEMA))
    want = plain({1: [("", 0), ("hi", 1), ("hi", 1)], 2: [("", 0)]})
    assert rows(prefix_trie.prefix_trie(turns)) == want
    turnless = spark.createDataFrame([(7, None), (3, [])], "conv_id long, turns array<struct<turn: long, digest: string, words: long>>")
    assert rows(prefix_trie.prefix_trie(turns.union(turnless))) == plain({1: [("", 0), ("hi", 1), ("hi", 1)], 2: [("", 0)], 7: [], 3: []})
    assert rows(prefix_trie.prefix_trie(turnless.where(F.lit(False)))) == []
