import random
import re

import numpy as np

from terrane.llm import ngram_join as nj


def grams(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute(docs, n, num, den):
    """(n_shingles, component by position) of every row, over all pairs."""
    sets = [grams(t, n) for _, t in docs]
    comp = list(range(len(docs)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                comp[root(i)] = root(j)
    members = {}
    for i in range(len(docs)):
        members.setdefault(root(i), []).append(docs[i][0])
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    return [(len(s), least[root(i)]) for i, s in enumerate(sets)]


def test_against_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    texts = []
    for size in (1, 2, 3, 4, 9, 12, 25, 60, 150, 400):
        for _ in range(3):
            base = [word() for _ in range(size)]
            texts.append(" ".join(base))
            for _ in range(6):  # a chain of copies, each a little off the one before
                for _ in range(rng.randint(0, max(1, size // 60))):
                    base[rng.randrange(size)] = word()
                if rng.random() < 0.3:
                    base = base + [word()] if rng.random() < 0.5 else base[1:] or base
                    size = len(base)
                texts.append("\t".join(base).upper())
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(rng.choice((2, 4, 8, 30)))) for _ in range(40)]
    texts += [None, "", "  \n", "one", "ONE", "one two", "É é", "é é"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[0]), (7, texts[0]), (None, texts[1]), (None, "only null ids here"), (None, "only null ids here")]
    rng.shuffle(docs)
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, node string, n int")
    for n, num, den in ((3, 90, 100), (2, 80, 100)):
        got = nj.link_documents(frame, n, num, den).collect()
        want = [(d, *w) for (d, _), w in zip(docs, brute(docs, n, num, den), strict=True)]
        want = [(d, k, c if k else d) for d, k, c in want]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert nj.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_pair_at_the_threshold_agrees_in_a_block():
    rng = np.random.default_rng(0)
    for size in (*range(1, 60), 181, 182, 500, 3000):
        pool = rng.integers(0, 2**63, 2 * size + 2).astype(np.uint64)
        for extra in range(size // 9 + 1):  # y has what x has, but `extra` entries less
            x, y = np.sort(pool[:size]), np.sort(pool[: size - extra])
            a, b = nj.block_keys([x, y], 90, 100)
            linked = 100 * len(y) >= 90 * len(x)
            assert not linked or len(np.intersect1d(a, b)), (size, extra)
            assert nj.masked_product([x], [y], 90, 100)[0] == linked
