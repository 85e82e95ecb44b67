import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402
from terrane.llm import token_store  # noqa: E402
from terrane.llm._tokens import PieceEncoder  # noqa: E402
from terrane.llm.packing import best_fit_decreasing, pack_documents, pack_lengths  # noqa: E402

ODD = [None, "", " ", "  ", "a  b", "a \n b", " a", "a ", "x\n", "\tq  z", "don't  'll", "it 's<|endoftext|> x <|startoftext|>", "a\0b c", "é ́a", "日本 語", "a  b", "A  B c", "x\x1c y", "1²3 ½ _ -- a", "İ ıİ क़ x", "word " * 6000]
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def whole(path, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_pieces_equal_whole_texts(name):
    path = public_tokenizers.path(name)
    rng = random.Random(5)
    texts = [t or "" for t in ODD] + ["".join(rng.choice(" \n\tab 'sé.1İ") for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    encoder = PieceEncoder(path)
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.whole.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want and encoder.encode(texts[::-1]) == want[::-1]


class Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0

    def encode_batch_fast(self, texts, **kw):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **kw)


@pytest.mark.parametrize("name", FILES)
def test_each_word_is_encoded_once_and_by_the_model(name):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdeéñz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    texts = ["".join(f"{rng.choice(words)}{rng.choice(['', ',', '.', '!?', ').'])}{rng.choice([' ', ' ', chr(10)])}" for _ in range(400)) for _ in range(50)]
    encoder = PieceEncoder(public_tokenizers.path(name))
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.whole.encode_batch(texts, add_special_tokens=False)]
    encoder.whole, encoder.model = whole, model = Counting(encoder.whole), Counting(encoder.model)
    assert encoder.encode(texts) == want and encoder.encode(texts) == want
    assert whole.chars < 500 and model.chars < 10 * 3 * len(words)


@pytest.mark.parametrize("name", FILES)
def test_line_ends_and_blanks_anywhere(name):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["\n", "\n", " ", "\t", "\r", "\x01", "\x85", "a", "Foo", "é,", "x.", "'s", "Ж", "12", "<"]) for _ in range(rng.randint(0, 7))) for _ in range(6000)]
    encoder = PieceEncoder(public_tokenizers.path(name))
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.whole.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


def test_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(0)
    for n, limit in ((1, 16), (2, 16), (300, 9), (5000, 16), (40, 6)):
        counts = np.concatenate([rng.integers(1, 10**6, n), [0]])
        lengths = token_store.code_lengths(counts, limit)
        assert lengths[-1] == 0 and lengths.max() <= limit and (2.0 ** -lengths[:-1].astype(float)).sum() <= 1
        share = counts[:-1] / counts.sum()
        assert (lengths[:-1] * share).sum() <= -(share * np.log2(share)).sum() + 1
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    assert token_store.code_lengths(fib, 16).max() == 11 and token_store.code_lengths(fib, 5).max() == 5


def test_block_round_trip():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.01, 50_000), 3000).astype(np.int64)
    ends = np.array([0, 1, 129, 257, 257, 40_000, 50_000])
    book = token_store.Codebook(token_store.code_lengths(np.bincount(ids)))
    code, n_bytes, points, n_points = book.encode(ids, ends)
    a, b = np.cumsum([0, *n_bytes]), np.cumsum([0, *n_points])
    blob = token_store.pack_block(np.arange(7), np.zeros(7, bool), np.diff(ends, prepend=0), [points[i:j].tobytes() for i, j in zip(b, b[1:])], [code[i:j] for i, j in zip(a, a[1:])])
    _, _, sizes, back = token_store.unpack_block(blob, book)
    assert (back == ids).all() and (np.cumsum(sizes) == ends).all()


def test_files_give_back_all_ids(spark, monkeypatch):
    monkeypatch.setattr(token_store, "RANGE_IDS", 4000)
    path = public_tokenizers.path(FILES[0])
    rows = [(i * 7 % 61 - 5, t, "clash") for i, t in enumerate(ODD * 3)] + [(None, "null id", ""), (3, "repeated id", "")]
    rows += [(None, f"null {i} " * 40, "") for i in range(50)] + [(17, f"hot {i} " * 40, "") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    target = token_store.write_ids(frame, token_store.fresh_target(spark), path, 1)
    got = sorted(token_store.read_ids(spark, target).collect(), key=lambda r: r.start)
    want = sorted((i is not None, i or 0, tuple(whole(path, t) + [1])) for i, t, _ in rows)
    assert [r.doc_id for r in got] == [i if known else None for known, i, _ in want]
    assert sorted((r.doc_id is not None, r.doc_id or 0, tuple(np.frombuffer(r.ids, "<u4"))) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    none = token_store.write_ids(frame.limit(0), token_store.fresh_target(spark), path, 1)
    assert token_store.read_ids(spark, none).count() == 0


def test_packing(spark):
    path = public_tokenizers.path(FILES[1])
    rows = [(i, t, 9) for i, t in enumerate(ODD * 4)] + [(None, "null id", 1), (3, "again", 2), (3, "again", 2)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, offset int"), path, window=64, with_ids=True).collect()
    windows, docs = {}, {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.doc_id, []).append((r.piece, r.start, bytes(r.ids)))
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for places in windows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for i, t, _ in rows[: len(ODD) * 4]:
        if i == 3:
            continue
        ids = whole(path, t) + [0]
        pieces = sorted(docs[i])
        assert b"".join(x[2] for x in pieces) == np.array(ids, "<u4").tobytes()
        assert [x[0] for x in pieces] == list(range(-(-len(ids) // 64)))
        assert all(len(x[2]) == 256 for x in pieces[1:])
    assert len(docs[3]) == 3 and len(docs[None]) == 1
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), path).count() == 0


def test_few_windows():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(1, 2049, 9000), rng.integers(300, 900, 9000), rng.integers(1, 60, 9000), np.full(50, 2048), np.array([1])):
        window, _ = pack_lengths(lengths, 2048)
        assert np.bincount(window, lengths).max() <= 2048
        assert len(np.unique(window)) <= 1.02 * lengths.sum() / 2048 + 1


def test_never_more_windows_than_best_fit_decreasing():
    rng = np.random.default_rng(4)
    mixes = [
        np.concatenate([rng.integers(1025, 1100, 3000), rng.integers(690, 760, 3000), rng.integers(200, 330, 3000)]),
        rng.integers(1, 2049, 9000), rng.integers(600, 800, 9000), np.concatenate([rng.integers(900, 1024, 3000), rng.integers(1024, 1150, 3000)]), np.clip(rng.lognormal(6, 1, 9000), 1, 2048).astype(np.int64),
        np.array([5]), np.empty(0, np.int64),
    ]
    found = []
    for lengths in mixes:
        window, offset = pack_lengths(lengths, 2048)
        plain = best_fit_decreasing(lengths, 2048)[0].max(initial=-1) + 1
        assert len(np.unique(window)) == window.max(initial=-1) + 1 <= plain
        order = np.lexsort((offset, window))
        w, o, n = window[order], offset[order], lengths[order]
        follows = w[1:] == w[:-1]
        assert (o[1:] == np.where(follows, o[:-1] + n[:-1], 0)).all() and (o + n <= 2048).all()
        found.append((window.max(initial=-1) + 1, plain))
    assert found[2][0] < 0.95 * found[2][1]  # three to a window, which best-fit decreasing misses
