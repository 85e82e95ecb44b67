"""Quality classification by a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins by quantiles of the sample. Cyclic boosting goes round the
features; each turn fits a shallow tree to the gradients of the log loss, whose leaves are runs of
the feature's bins, and adds it, shrunk, to the feature's lookup table. Then the pairs whose
quadrants explain most of what is left get two-way tables in the same manner. A score is the
sigmoid of a sum of table entries: one vectorised look-up and addition for each table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import OWN, as_bytes, text_of
from terrane.llm.lang_id import fold, least_hashes

#: Labelled rows that the fit uses at most, those with the least hash of their id.
TRAIN_ROWS = 20_000
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "upper", "digits", "blanks", "newlines", "dots", "exclaimed", "piped", "symbols",
    "high_bytes", "line_bytes", "longest_line", "same_lines", "distinct_words", "top_word", "packed", "sentence_words", "capital_words",
)

_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".,;:", b"!?", b"|", b"#$%&*@^~<>{}[]\\/=+_", bytes(range(128, 256))), 1):
    _CLASS[list(_chars)] = _k


def features(texts: list[bytes]) -> np.ndarray:
    """One row of numbers a text, over the whole text; all 0 for the empty one."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, t in enumerate(texts):
        if not t:
            continue
        counts = np.bincount(_CLASS[np.frombuffer(t, np.uint8)], minlength=10) / len(t)
        words, lines = t.split(), t.split(b"\n")
        n, filled = len(words), [x for x in lines if x.strip()]
        tally = Counter(words)
        lengths = list(map(len, words)) or [0]
        top = tally.most_common(1)[0][1] if n else 0
        capital = sum(c for w, c in tally.items() if w[:1].isupper())
        out[i] = (
            np.log1p(len(t)), np.log1p(n), sum(lengths) / max(1, n), max(lengths), *counts[1:10],
            np.log1p(len(t) / len(lines)), np.log1p(max(map(len, lines))), 1 - len(set(filled)) / max(1, len(filled)),
            len(tally) / max(1.0, n) ** 0.85, top / max(1, n), len(zlib.compress(t, 1)) / len(t),
            n / (1 + t.count(b".")), capital / max(1, n),
        )
    return out


@dataclass
class Gam:
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    intercept: float
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)])

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, self.bins(x, self.cuts), strict=True):
            z += table[b]
        if self.pairs:
            rough = self.bins(x, self.coarse)
            for (i, j), grid in zip(self.pairs, self.grids, strict=True):
                z += grid[rough[i], rough[j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Leaf values over bins of a greedy tree with so many leaves, from sums of gradients and curvatures."""
    sg, sh = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    edges = [0, len(g)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            left, right = (sg[k] - sg[a], sh[k] - sh[a]), (sg[b] - sg[k], sh[b] - sh[k])
            gain = _gain(*left, ridge) + _gain(*right, ridge) - _gain(sg[b] - sg[a], sh[b] - sh[a], ridge)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), int(k[at]))
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(edges, edges[1:], strict=False):
        out[a:b] = (sg[b] - sg[a]) / (sh[b] - sh[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four quadrants: its gain and its leaf values."""
    cg, ch = (np.pad(x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (g, h))

    def corner(c):
        a = c[1:-1, 1:-1]
        rows, columns, whole = c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return a, rows - a, columns - a, whole - rows - columns + a

    parts = list(zip(corner(cg), corner(ch), strict=True))
    gain = sum(_gain(a, b, ridge) for a, b in parts)
    if not gain.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [a[i, j] / (b[i, j] + ridge) for a, b in parts]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 150, leaves: int = 4, rate: float = 0.1, pairs: int = 6, pair_bins: int = 12, pair_rounds: int = 60, ridge: float = 2.0) -> Gam:
    def quantiles(n: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(c, np.arange(1, n) / n)) for c in x.T]

    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Gam(quantiles(bins), [], float(np.log(share / (1 - share))))
    fine = model.bins(x, model.cuts)
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    z = np.full(len(x), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for b, table in zip(fine, model.tables, strict=True):
            g, h = slopes()
            step = rate * _tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)), leaves, ridge)
            table += step
            z += step[b]
    model.coarse = quantiles(pair_bins)
    rough = model.bins(x, model.coarse)
    shape = [len(c) + 1 for c in model.coarse]

    def sums(i: int, j: int):
        at = rough[i] * shape[j] + rough[j]
        return (np.bincount(at, v, shape[i] * shape[j]).reshape(shape[i], shape[j]) for v in slopes())

    found = sorted(((_quadrants(*sums(i, j), ridge)[0], i, j) for i in range(len(shape)) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in found[:pairs] if gain > 0]
    model.grids = [np.zeros((shape[i], shape[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            step = rate * _quadrants(*sums(i, j), ridge)[1]
            grid += step
            z += step[rough[i], rough[j]]
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(as_bytes(batch, "text"))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["quality", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Gam | None:
    """Fit on at most ``rows`` labelled rows whose fold is not 0; None without labels of both kinds."""
    wanted = labels.where(F.coalesce(fold(F.col(id_col)) != 0, F.lit(False)) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("quality"))
    wanted = least_hashes(wanted, "doc_id", rows, wanted.count()).orderBy("h", "doc_id", "quality").limit(rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    found = texts.join(wanted, "doc_id").select("text", "quality").mapInArrow(_featured, "quality int, x array<double>").toArrow()
    y = found.column("quality").to_numpy().astype(float)
    if len(np.unique(y)) < 2:
        return None
    x = np.array(found.column("x").to_pylist())
    order = np.lexsort([*x.T, y])  # the same fit whatever order the rows come in
    return fit(x[order], y[order])


def score_quality(docs: DataFrame, model: Gam | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if score >= threshold).

    The whole text alone decides; null and empty texts get the score of all-zero features, and
    without a model every row has 0.5. Columns ``score`` and ``predicted`` of ``docs`` are replaced, all
    others stay; every row stays, repeated ones too; an empty table stays empty.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    own = f"{OWN}text"
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(as_bytes(batch, own))
            s = model.score(x) if model is not None else np.full(len(x), 0.5)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*keep, "score", "predicted"])

    return docs.select(*keep, text_of(text_col).cast("binary").alias(own)).mapInArrow(run, schema)
