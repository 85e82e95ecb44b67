"""Benchmark decontamination with suffix arrays over the training texts.

A shard is a bounded batch of documents. Words that no benchmark item has can be part of no match
and cut a document into runs; the shard's suffix array orders all suffixes of the runs that are
long enough for the shortest window. Every suffix of every benchmark item is binary-searched
in it, word by word deeper: the interval that is left last gives its longest verbatim match and
all places of it, the interval at the depth of its window gives the words that are hit.

The benchmark is the stated query set: it goes to the tasks in blocks of bounded size, one after
the other, and what a block finds is added to what the ones before found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import as_bytes

#: Text bytes of the benchmark in one block, which one broadcast holds.
BLOCK_BYTES = 8 << 20
#: Text bytes of a shard.
SHARD_BYTES = 32 << 20

#: Letters and digits of ASCII, A-Z lower-cased, and all bytes of other characters are word bytes.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


class Benchmark:
    """A block of items: their words as numbers, and every suffix with the length of its window."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names, starts, ends, windows, codes = [], [], [], [], []
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            at = len(codes)
            codes += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            n = len(words)
            for i in range(n):
                starts.append(at + i)
                ends.append(at + n)
                windows.append(window if i + window <= n else n if n < window and i == 0 else 0)
                self.names.append(name)
        self.codes, self.starts, self.ends = np.array(codes + [0], np.int32), np.array(starts, np.int64), np.array(ends, np.int64)
        self.windows = np.array(windows, np.int64)
        self.shortest = int(self.windows[self.windows > 0].min(initial=window))
        self.longest = int((self.ends - self.starts).max(initial=0))


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of codes (0 ends a run) in order of their first ``depth`` words at least, by prefix doubling."""
    n = len(codes)
    rank = codes.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    k = 1
    while k < depth and k < n:
        ahead = np.zeros(n, np.int64)
        ahead[: n - k] = rank[k:] + 1
        ahead[codes == 0] = 0
        key = rank * (int(ahead.max()) + 1) + ahead
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = steps
        if steps[-1] == n - 1:
            break
        k *= 2
    return order


def _bound(codes: np.ndarray, order: np.ndarray, depth: int, word: np.ndarray, lo: np.ndarray, hi: np.ndarray, right: bool) -> np.ndarray:
    """In each interval, the first suffix whose word at this depth is not below (not above: right) the word."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        middle = (lo + hi) >> 1
        found = codes[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, len(codes) - 1)]
        below = (found <= word if right else found < word) & open_
        lo = np.where(below, middle + 1, lo)
        hi = np.where(open_ & ~below, middle, hi)
    return lo


def search(codes: np.ndarray, order: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every benchmark suffix: longest match, its interval, and the interval of its window (empty: none)."""
    n = len(bench.starts)
    longest = np.zeros(n, np.int64)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    w_lo, w_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    active = np.arange(n)
    for depth in range(bench.longest):
        active = active[bench.starts[active] + depth < bench.ends[active]]
        if not len(active):
            break
        word = bench.codes[bench.starts[active] + depth]
        a = _bound(codes, order, depth, word, lo[active], hi[active], False)
        b = _bound(codes, order, depth, word, a, hi[active], True)
        some = a < b
        active, a, b = active[some], a[some], b[some]
        lo[active], hi[active], longest[active] = a, b, depth + 1
        due = bench.windows[active] == depth + 1
        w_lo[active[due]], w_hi[active[due]] = a[due], b[due]
    return longest, lo, hi, w_lo, w_hi


def _places(order: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which interval, and where in the codes, for every member of the intervals."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return which, order[lo[which] + inside]


class Shard:
    """Suffix array of a batch of documents for one block of the benchmark."""

    def __init__(self, texts: list[bytes | None], bench: Benchmark):
        parts, self.n_words = [], np.zeros(len(texts), np.int64)
        get = bench.vocabulary.get
        for d, text in enumerate(texts):
            words = words_of(text)
            self.n_words[d] = len(words)
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            parts.append(np.zeros(1, np.int32))
        flat = np.concatenate([np.zeros(1, np.int32), *parts])
        self.first = np.concatenate([[0], np.cumsum(self.n_words + 1)])[:-1]  # where documents begin in positions
        stops = np.flatnonzero(flat == 0)
        length = np.diff(stops) - 1
        keep = length >= bench.shortest
        begin, length = stops[:-1][keep] + 1, length[keep]
        inside = np.arange(int((length + 1).sum())) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
        at = np.repeat(begin, length + 1) + inside
        self.codes, self.position = flat[at], at - 1  # each run with the stop after it
        self.order = suffix_array(self.codes, bench.longest + 1)
        self.order = self.order[self.codes[self.order] > 0]
        self.bench = bench

    def find(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Benchmark suffix, document, word offset and length of every window that occurs, and of longer matches from it."""
        longest, lo, hi, w_lo, w_hi = search(self.codes, self.order, self.bench) if len(self.order) else (np.zeros(0, np.int64),) * 5
        which, at = _places(self.order, w_lo, w_hi)
        position = self.position[at]
        document = np.searchsorted(self.first, position, "right") - 1
        best, best_at = _places(self.order, np.where(w_hi > w_lo, lo, 0), np.where(w_hi > w_lo, hi, 0))
        size = dict(zip(zip(best.tolist(), best_at.tolist(), strict=True), longest[best].tolist(), strict=True))
        length = np.array([size.get(x, 0) for x in zip(which.tolist(), at.tolist(), strict=True)], np.int64)
        return which, document, position - self.first[document], np.maximum(length, self.bench.windows[which])


def _scan(bench):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = bench.value
        for batch in batches:
            texts = as_bytes(batch, "text")
            sizes = np.cumsum([len(t or b"") for t in texts])
            cuts = np.searchsorted(sizes, np.arange(SHARD_BYTES, int(sizes[-1]) + SHARD_BYTES if len(sizes) else 0, SHARD_BYTES), "right")
            cuts = np.unique([0, *cuts.tolist(), len(texts)])
            for a, b in zip(cuts, cuts[1:], strict=False):
                shard = Shard(texts[a:b], block)
                which, document, offset, length = shard.find()
                order = np.argsort(document, kind="stable")
                ends = np.searchsorted(document[order], np.arange(b - a), "right")
                spans, items, i = [], [], 0
                old_spans, old_items = (batch.column(batch.schema.get_field_index(c)).slice(a, b - a).to_pylist() for c in ("spans", "items"))
                for d, e in enumerate(ends.tolist()):
                    mine = order[i:e]
                    i = e
                    spans.append(old_spans[d] + np.stack([offset[mine], block.windows[which[mine]], length[mine]], 1).ravel().tolist())
                    items.append(sorted({*old_items[d], *(block.names[x] for x in which[mine])}))
                part = batch.slice(a, b - a)
                new = {"n_words": pa.array(shard.n_words), "spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(c, part.column(k)) for k, c in enumerate(batch.schema.names)], batch.schema.names)

    return run


def _hits(keep_text: bool):
    """Covered words, longest match and digest of the items, from the triples (offset, window, match)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield summed(batch)

    def summed(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, items, n_words = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("spans", "items", "n_words"))
        hit, longest = [], []
        for s, n in zip(spans, n_words, strict=True):
            t = np.array(s, np.int64).reshape(-1, 3)
            edges = np.bincount(t[:, 0], minlength=n + 1) - np.bincount(t[:, 0] + t[:, 1], minlength=n + 1) if len(t) else np.zeros(1, int)
            hit.append(int((np.cumsum(edges) > 0).sum()))
            longest.append(int(t[:, 2].max(initial=0)))
        digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        columns = [pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digests), pa.array([h > 0 for h in hit]), pa.array(longest, pa.int64())]
        names = [c for c in batch.schema.names if keep_text or c != "text"]
        return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *columns], [*names, "n_hit", "n_items", "items_sha256", "contaminated", "longest_match"])

    return run


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, bytes | None]]]:
    """The benchmark in blocks of bounded bytes (a single longer item is a block of its own)."""
    held, size = [], 0
    for name, text in benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("binary")).toLocalIterator():
        text = bytes(text or b"")
        if held and size + len(text) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((name if name is not None else "", text))
        size += len(text)
    if held:
        yield held


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, spans, items, n_hit, n_items, items_sha256, contaminated, longest_match of every document.

    Words are runs of ASCII letters (A-Z lower-cased), digits and other characters. A window is
    ``window`` consecutive words of an item, or all of an item with fewer; a document word inside
    an occurrence of a window is hit. ``spans`` has, flat, a word offset, the window's length and
    the length of the longest verbatim match from there that the item's suffix has anywhere in the
    shard (else the window's). ``keep_text`` adds the text, as binary, after doc_id. Null and empty texts have no words and items without words no window. Every row
    is a document of its own, also with a null or repeated id; a null item id counts as the empty
    string, items of one id are one. Other columns are ignored; empty tables are fine.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<bigint>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items")
    )
    schema = f"doc_id {id_type}, text binary, n_words long, spans array<bigint>, items array<string>"
    blocks = benchmark_blocks(benchmark, item_col, item_text_col)
    for block in chain([next(blocks, [])], blocks):
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(Benchmark(block, window))), schema)
    out = f"doc_id {id_type}, {'text binary, ' * keep_text}n_words long, spans array<bigint>, items array<string>, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long"
    return rows.mapInArrow(_hits(keep_text), out)
