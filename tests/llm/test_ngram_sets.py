import numpy as np
import pytest

pytest.importorskip("xxhash")
from terrane.llm import ngram_join  # noqa: E402


def test_a_batch_is_hashed_at_once_and_like_its_texts_alone(monkeypatch):
    calls, plain = [], ngram_join.mix
    monkeypatch.setattr(ngram_join, "mix", lambda x: calls.append(len(x)) or plain(x))
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcdefg"), k)).encode() for k in rng.integers(3, 40, 200)]
    hashes = ngram_join.WordHashes()
    together = ngram_join.ngram_sets(texts, 3, hashes)
    assert len(calls) == 3
    for n, mixed in ((3, [*texts, None, b"", b" ", b"a", b"A b", b"a a a a"]), (50, texts), (1, texts)):
        alone = [ngram_join.ngram_sets([t], n, hashes)[0] for t in mixed]
        assert all(np.array_equal(x, y) for x, y in zip(ngram_join.ngram_sets(mixed, n, hashes), alone, strict=True))
    for text, found in zip(texts, together, strict=True):
        words = text.split()
        assert len(found) == len({tuple(words[i : i + 3]) for i in range(len(words) - 2)})
    assert ngram_join.ngram_sets([], 3, hashes) == [] and ngram_join.ngram_sets([b"x Y"], 3, hashes)[0].tolist() == ngram_join.ngram_sets([b"X y"], 3, hashes)[0].tolist()
