"""Runs (maximal repetitions of words) by the runs theorem.

Every run of period p has a root that is a longest Lyndon word, under the order of the words or under the
reverse one: so the roots are found without trying periods. The longest Lyndon word at a place ends where
the next smaller suffix begins, which is a next smaller value of the inverse suffix array. A root of length
p at i goes on to the right by the longest common extension of i and i + p, to the left by that
of the reversed text: minima over the array of longest common prefixes. At most two candidates a word
are looked at, however periodic the text.

The texts of an Arrow batch are one sequence, in which a word of one text differs from every word of another and each
text ends with a symbol of its own below its words. So one pass of array operations serves many texts, and a
long text needs memory in proportion to its words. There is no shuffle: texts do not meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import as_bytes, tidy
from terrane.llm._rmq import RangeMin, next_smaller

RUNS = "array<struct<start: long, length: long, period: long>>"
#: Words that common prefixes are extended by for all pairs at once, before pairs go one by one.
TOGETHER = 16


def suffix_ranks(symbols: np.ndarray, upto: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The rank of every suffix, by prefix doubling of those that are not told apart yet; and these.

    With ``upto``, only that many first symbols are looked at (rounded up to a power of two). The last symbol of a text must be unlike all others.
    """
    n, rank = len(symbols), np.empty(len(symbols), np.int64)
    old, left, k = np.zeros(n, np.int64), np.arange(n), 0
    key = symbols.astype(np.int64)
    while len(left):
        order = np.argsort(key)
        left, key, old = left[order], key[order], old[order]
        fresh, group = (np.concatenate([[True], x[1:] != x[:-1]]) for x in (key, old))
        place = np.arange(len(left))
        first = place[fresh][np.cumsum(fresh) - 1]
        rank[left] = old + first - place[group][np.cumsum(group) - 1]
        alone = fresh & np.concatenate([fresh[1:], [True]])
        left = left[~alone]
        k = 2 * k or 1
        if upto is not None and k >= upto:
            break
        old = rank[left]
        key = old * n + rank[left + k]  # no symbol that ends a text is among the first k, so left + k is within the text
    return rank, left


def common_prefixes(symbols: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix in order and the one before it.

    Only irreducible values are extended word by word; their sum is O(n log n). Each other one is its left neighbour's less one.
    """
    n = len(symbols)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    same = np.zeros(n, bool)
    same[1:] = (before[1:] > 0) & (symbols[:-1] == symbols[np.maximum(before[1:], 1) - 1])
    same[1:] &= before[:-1] >= 0
    own = np.flatnonzero(~same)
    length = np.zeros(n, np.int64)
    left = own[before[own] >= 0]
    for step in range(TOGETHER):
        left = left[symbols[left + step] == symbols[before[left] + step]]
        length[left] = step + 1
    for i in left.tolist():
        a, b, step = i + TOGETHER, int(before[i]) + TOGETHER, 4 * TOGETHER
        while True:  # a text's last symbol ends it
            m = min(step, n - max(a, b))
            unlike = symbols[a : a + m] != symbols[b : b + m]
            if unlike.any():
                length[i] = a + int(unlike.argmax()) - i
                break
            a, b, step = a + m, b + m, 2 * step
    last = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    return (length[last] - (np.arange(n) - last))[order]


class Extensions:
    """Longest common extensions to the right of two places, by ranks and range minima."""

    def __init__(self, symbols: np.ndarray, rank: np.ndarray):
        self.rank, self.mins = rank, RangeMin(common_prefixes(symbols, rank))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        return self.mins.least(np.minimum(a, b) + 1, np.maximum(a, b))


def runs_of(codes: list[np.ndarray], min_length: int = 12) -> list[np.ndarray]:
    """For each sequence of codes (from 0) its runs as rows (start, length, period), by start, then period.

    A run is a stretch with smallest period q and a length of at least max(min_length, 2 * q) that no neighbour extends.
    """
    out = [np.empty((0, 3), np.int64)] * len(codes)
    some = [k for k, c in enumerate(codes) if len(c) >= max(2, min_length)]
    if min_length > 4 and some:  # a run repeats half of its words: texts without a repeat that long have none
        repeats = -(-min_length // 2)
        power = 1 << (repeats.bit_length() - 1)
        symbols, text, _ = _joined([codes[k] for k in some])
        _, left = suffix_ranks(symbols, min(power, 4))
        some = [some[k] for k in np.unique(text[left])]
    if not some:
        return out
    mine = [codes[k] for k in some]
    symbols, text, starts = _joined(mine)
    ends = np.append(starts[1:], len(symbols)) - 1  # of each text's last symbol
    rank, _ = suffix_ranks(symbols)
    word = np.ones(len(symbols), bool)
    word[ends] = False
    place = np.flatnonzero(word)
    one, other = (next_smaller(x)[place] - place for x in (rank, suffix_ranks(_reversed_order(symbols, text, ends))[0]))
    apart = one != other
    i, p = np.concatenate([place, place[apart]]), np.concatenate([one, other[apart]])
    need = np.maximum(min_length, 2 * p) - p  # words that the extensions to both sides make together
    right, left = np.ones(len(i), bool), np.ones(len(i), bool)
    for step in range(3):  # one of them makes half of these: most candidates go by their next words
        asked, top = step < (need + 1) // 2, len(symbols) - 1
        right &= ~asked | (symbols[np.minimum(i + step, top)] == symbols[np.minimum(i + p + step, top)])
        left &= ~asked | ((i > step) & (symbols[np.maximum(i - 1 - step, 0)] == symbols[np.maximum(i + p - 1 - step, 0)]))
    i, p, need = (x[right | left] for x in (i, p, need))
    if not len(i):
        return out
    more = Extensions(symbols, rank).of(i, i + p)
    at = starts[text]
    mirror = at + (ends[text] - 1) - np.arange(len(symbols))  # a word's place in its reversed text
    mirror[ends] = ends
    backward = symbols[mirror]
    less, inside = np.zeros(len(i), np.int64), i > at[i]
    back = Extensions(backward, suffix_ranks(backward)[0])
    less[inside] = back.of(mirror[i[inside] - 1], mirror[i[inside] + p[inside] - 1])
    whole = less + more >= need
    i, p, more, less = (x[whole] for x in (i, p, more, less))
    start, length = i - less, less + p + more
    _, first = np.unique(start * len(symbols) + p, return_index=True)  # by start, then period
    owner = text[start[first]]
    rows = np.stack([start[first] - starts[owner], length[first], p[first]], axis=1)
    cuts = np.searchsorted(owner, np.arange(len(some) + 1))
    for k, a, b in zip(some, cuts[:-1], cuts[1:], strict=True):
        out[k] = rows[a:b]
    return out


def _joined(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sequence of all: symbols, the text that each belongs to, and where texts start."""
    sizes = np.array([len(c) + 1 for c in codes], np.int64)
    ends = np.cumsum(sizes)
    width = max((int(c.max(initial=0)) for c in codes), default=0) + 2
    text = np.repeat(np.arange(len(codes)), sizes)
    own = np.zeros(int(ends[-1]), np.int64)
    keep = np.ones(len(own), bool)
    keep[ends - 1] = False
    own[keep] = np.concatenate(codes) + 1
    return own + text * width, text, ends - sizes


def _reversed_order(symbols: np.ndarray, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbols with the order of a text's words turned round; its last symbol stays below them."""
    width = int((symbols - symbols[ends][text]).max(initial=0)) + 1
    own = symbols - symbols[ends][text]
    return np.where(own == 0, 0, width - own) + text * (width + 1)


class Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when every run is cut to its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def _find(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, codes = [(t or b"").split() for t in as_bytes(batch, "text")], Codes()  # ASCII white space alone splits bytes
            numbered = [np.fromiter(map(codes.__getitem__, w), np.int64, len(w)) for w in words]
            found = runs_of(numbered, min_length)
            flat = np.concatenate([*found, np.empty((0, 3), np.int64)])
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]), pa.int32())
            runs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in flat.T], ["start", "length", "period"])
            texts = []
            for w, x in zip(words, found, strict=True):
                if len(x):
                    w = [w[k] for k in np.flatnonzero(kept_words(len(w), x))]
                texts.append(b" ".join(w))
            n = pa.array([len(w) for w in words], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.ListArray.from_arrays(offsets, runs), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "text"])

    return run


def find_runs(docs: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs, text of every row: the runs of its words as (start, length, period), by start, then
    period, and its words without those that a run contains after its first period, joined by one space.

    Words are runs of other than ASCII white space. A run is a stretch of consecutive words with smallest period q (words q
    apart are identical) and a length of at least max(min_length, 2 * q) that no neighbouring word extends. A null or empty text
    has no words and no runs; repeated rows and null ids are rows of their own; a very long text is one row of one task, with memory in
    proportion to its words; other columns are ignored; an empty table gives no rows.
    """
    if min_length < 2:
        raise ValueError("a run has two words at least")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(_find(min_length)), f"doc_id {id_type}, n_words long, runs {RUNS}, text string")
