"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the byte 2-, 3- and 4-grams of the text with A-Z lower-cased and other ASCII than
letters made blank. Each hashes to a row of an embedding table; a text is the average of its
subwords' rows, and a linear softmax over it gives the languages. Stochastic gradient descent in
numpy fits both on a bounded sample. On a part of the sample that the fit does not see, a
temperature calibrates the probabilities and a threshold is set below which a text is rejected.

As averaging and softmax are linear up to the last step, scoring uses the product of both tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import as_bytes, text_of

#: Labelled rows that the fit uses at most, those with the least hash of their id.
TRAIN_ROWS = 4000
BITS = 13
GRAMS = (2, 3, 4)
DIM = 16
SLICE = 1 << 20
#: Rows of the embedding table get small gradients, as a text is an average over many: they step further, within bounds.
SPARSE, CLIP = 64.0, 0.05

LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def fold(doc_id: Column) -> Column:
    return (F.crc32(doc_id.cast("string").cast("binary")) % 5).cast("int")


def least_hashes(df: DataFrame, id_col: str, rows: int, total: int) -> DataFrame:
    """``df`` with a hash ``h`` of the id, cut down to about 1.5 times the rows wanted before they are ordered by it."""
    scale = 1 << 30
    share = min(scale, -(-scale * (rows * 3 // 2 + 200) // max(1, total)))
    return df.withColumn("h", F.pmod(F.xxhash64(id_col), F.lit(scale))).where(F.col("h") < share)


def has_letter(text: bytes) -> bool:
    folded = text.translate(LETTERS)
    return any(97 <= b <= 122 for b in set(folded)) or not folded.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _buckets(data: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram at every place but the last n - 1."""
    g = np.full(len(data) - n + 1, n, np.uint32)
    for i in range(n):
        g = (g << np.uint32(8) | g >> np.uint32(24)) ^ data[i : len(data) - n + 1 + i]
        g = g * np.uint32(0x9E3779B1)
    return (g >> np.uint32(32 - BITS)).astype(np.int32)


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE bytes."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def averages(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Mean row of ``table`` over the subwords of each text."""
    out = np.zeros((len(texts), table.shape[1]), np.float64)
    for a, b in slices(texts):
        # a blank at both ends of each text; grams of two texts meet only in the blanks between
        data = np.frombuffer(b" " + b"   ".join(t.translate(LETTERS) for t in texts[a:b]) + b"    ", np.uint8).astype(np.uint32)
        sizes = np.array([len(t) for t in texts[a:b]])
        begin = np.cumsum(sizes + 3) - sizes - 3
        total, count = np.zeros((b - a, table.shape[1])), np.zeros(b - a)
        for n in GRAMS:
            rows = _buckets(data, n)
            stop = begin + sizes + 2 - n + 1  # grams inside the text and its two blanks
            some = np.flatnonzero(stop > begin)
            if not len(some):
                continue
            edges = np.stack([begin[some], stop[some]], 1).ravel()
            total[some] += np.stack([np.add.reduceat(np.append(column[rows], 0.0), edges)[::2] for column in table.T.astype(np.float64)], 1)
            count[some] += stop[some] - begin[some]
        out[a:b] = total / np.maximum(count, 1)[:, None]
    return out


def histograms(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text, and their shares."""
    out = []
    for t in texts:
        data = np.frombuffer(b" " + t.translate(LETTERS) + b" ", np.uint8).astype(np.uint32)
        found = np.bincount(np.concatenate([_buckets(data, n) for n in GRAMS if len(data) >= n] or [np.empty(0, np.int32)]), minlength=1 << BITS)
        used = np.flatnonzero(found)
        out.append((used.astype(np.int32), (found[used] / max(1, found.sum())).astype(np.float32)))
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        z = (mean + self.bias) / self.temperature
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    x = np.zeros((len(rows), 1 << BITS), np.float32)
    for i, (at, share) in enumerate(rows):
        x[i, at] = share
    return x


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 12, batch: int = 64, rate: float = 1.0, precision: float = 0.99, seed: int = 17) -> Model:
    """SGD with a linearly falling rate; every fifth row calibrates."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels], np.int64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, train = order[::5], np.delete(order, np.s_[::5])
    if not len(train):
        train = held
    k = len(languages)
    embed = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIM, k)).astype(np.float32)
    bias = np.zeros(k, np.float32)
    steps, step = epochs * -(-len(train) // batch), 0
    for _ in range(epochs):
        rng.shuffle(train)
        for i in range(0, len(train), batch):
            mine = train[i : i + batch]
            active, where = np.unique(np.concatenate([rows[j][0] for j in mine]), return_inverse=True)
            x = np.zeros((len(mine), len(active)), np.float32)
            x[np.repeat(np.arange(len(mine)), [len(rows[j][0]) for j in mine]), where] = np.concatenate([rows[j][1] for j in mine])
            hidden = x @ embed[active]
            z = hidden @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(mine)), y[mine]] -= 1
            p /= len(mine)
            now = rate * (1 - step / steps)
            grad = x.T @ (p @ soft.T)
            grad *= min(1.0, CLIP / max(float(np.linalg.norm(grad)), 1e-12))
            soft -= now * (hidden.T @ p)
            bias -= 0.1 * now * p.sum(0)
            embed[active] -= now * SPARSE * grad
            step += 1
    model = Model(languages, embed @ soft, bias)
    mean = np.stack([rows[i][1] @ model.table[rows[i][0]] for i in held]) if len(held) else np.zeros((0, k))
    at = np.arange(len(held))

    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(np.maximum(model.probabilities(mean)[at, y[held]], 1e-12)).mean()

    model.temperature = min((float(t) for t in np.geomspace(0.2, 5, 60)), key=loss) if len(held) else 1.0
    if len(held):
        p = model.probabilities(mean)
        best = np.argsort(p.max(1))
        right = (p.argmax(1) == y[held])[best]
        share = np.cumsum(right[::-1])[::-1] / np.arange(len(right), 0, -1)  # precision if all from here on are accepted
        good = np.flatnonzero(share >= precision)
        model.threshold = float(p.max(1)[best][good[0]]) if len(good) else 1.0
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = histograms([t or b"" for t in as_bytes(batch, "text")])
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([a.tobytes() for a, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary())], ["lang", "at", "share"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most ``rows`` rows with text and language whose fold is not 0; None if there are none."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.coalesce(fold(F.col(id_col)) != 0, F.lit(False)))
    rows_of = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id")).where("text is not null")
    sample = least_hashes(rows_of, "id", rows, labelled.count()).orderBy("h", "lang").limit(rows)
    found = sample.select("text", "lang").mapInArrow(_features, "lang string, at binary, share binary").toArrow()
    if not found.num_rows:
        return None
    at, share = ([np.frombuffer(x, t) for x in found.column(c).to_pylist()] for c, t in (("at", np.int32), ("share", np.float32)))
    return fit(list(zip(at, share, strict=True)), found.column("lang").to_pylist())


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang, lang_pred, score, rejected of every row, from its whole text alone.

    ``lang_pred`` is the likeliest learned language and ``score`` its calibrated probability; it is
    ``und`` with score 0 for a null text or one without a letter (or without a model). ``rejected``
    tells a score below the model's threshold, and ``lang`` is ``und`` for those too. Repeated
    rows and null ids are rows like others; further columns are ignored; an empty table stays empty.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch, "text")
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if model is not None and t and has_letter(t)]
            if known:
                p = model.probabilities(averages([texts[i] for i in known], model.table))
                pred[known], score[known] = np.array(model.languages, object)[p.argmax(1)], p.max(1)
            rejected = score < (model.threshold if model is not None else 1.0)
            lang = np.where(rejected, "und", pred)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "lang", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {id_type}, lang string, lang_pred string, score double, rejected boolean")
