"""Token ids of whole texts, by the tokenizers library, with a bounded memo of space-separated pieces.

Byte level (a space belongs to what follows): a text is the sequence of its pieces at the spaces,
and no pre-token crosses the boundary before a space that follows a non-space, nor those around a
single line end. Word level (white space dropped, lower case): a text is the sequence of its pieces at
white space. Marks behind a word are a piece of their own. The library encodes each distinct piece
once, words of Latin letters by its model without the pre-tokenizer, which has nothing to part
there. Pieces are split, told apart, looked up and put together as Arrow columns, so a batch costs
Python objects for its new pieces only. A text for which that is not safe, or that holds an added
token of the file, is encoded whole. Results equal the library's plain call on whole texts, which the tests check.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers, some 10 MB. Beyond it only those of the last batch stay.
MEMO_PIECES = 180_000
PIECES_A_CALL = 5_000
#: Characters of texts that are split into pieces at a time.
CHARS_AT_ONCE = 1 << 21

#: Begins a piece that has no space before it: one at a line end or behind it, at a text's start, or behind a word.
BARE = "\x01"
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"  # without the apostrophe
WORD, BARE_WORD = f"^[{LETTERS}]+$", f"^{BARE}[{LETTERS}]+$"
TAILED = f"^(?P<head>{BARE}?[{LETTERS}]+)(?P<tail>[{MARKS}]+)$"
SPACES = "\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Word level: anything but characters below U+0250 and common punctuation, which the normalizer may join to others.
ODD = f"[^{LETTERS}{MARKS}'‐-‧‰-⁞0-9]"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a vocabulary; spaces stay."""
    own = [*range(32, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own[1:]]
    return {b: chr(256 + i) for i, b in enumerate(others)} | {b: chr(b) for b in own}


def blobs(ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Ids between the cuts as little-endian unsigned 32-bit integers."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer((4 * cuts).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])


class PieceEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = Tokenizer(self.whole.model)  # of words in byte letters
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        vocab = self.whole.get_vocab()
        self.leading = "Ġthe" in vocab  # a space belongs to the word after it
        self.letters, self.space = byte_letters(), vocab.get("Ġ")
        edge = [i for t, i in vocab.items() if (t.startswith("Ġ") if self.leading else t.endswith("</w>"))]
        self.edge = np.zeros(max(vocab.values()) + 1, bool)  # ids that begin (byte level) or end (word level) a piece
        self.edge[edge] = True
        self.pieces, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _modelled(self, words: list[str], before: str) -> np.ndarray:
        """Ids of words by the model alone; ``before`` stands in front of each."""
        text = " ".join(words)
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        text = before + text.replace(" ", f" {before}")
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _words(self, words: list[str], bare: bool) -> pa.Array:
        """Ids of words that have one edge each; bare ones stand behind a space of their own, which goes."""
        if not bare or not self.leading:
            ids = self._modelled(words, "Ġ" if self.leading else "")
            at = np.flatnonzero(self.edge[ids])
            cuts = np.append(at, len(ids)) if self.leading else np.concatenate([[0], at + 1])
        else:
            ids = self._modelled(words, "Ġ ")
            at = np.flatnonzero(ids == self.space)
            ids, cuts = np.delete(ids, at), np.append(at - np.arange(len(at)), len(ids) - len(at))
        if len(cuts) != len(words) + 1 or cuts[0] or cuts[-1] != len(ids):
            raise RuntimeError("a word has other than one edge")
        return blobs(ids, cuts)

    def _learn(self, new: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The same pieces in some order, and their ids."""
        word, bare = pc.match_substring_regex(new, WORD), pc.match_substring_regex(new, BARE_WORD)
        pieces, ids = [], []
        for kind, mine in (("word", new.filter(word)), ("bare", new.filter(bare)), ("other", new.filter(pc.invert(pc.or_(word, bare))))):
            for i in range(0, len(mine), PIECES_A_CALL):
                part = mine[i : i + PIECES_A_CALL]
                texts = part.to_pylist()
                pieces.append(part)
                if kind != "other":
                    ids.append(self._words([t.lstrip(BARE) for t in texts], kind == "bare"))
                else:
                    texts = [t[1:] if t[:1] == BARE else f" {t}" if self.leading else t for t in texts]
                    ids.append(pa.array(self._encode(texts), pa.large_binary()))
        return pa.concat_arrays(pieces), pa.concat_arrays(ids)

    def _known(self, pieces: pa.Array) -> pa.Array:
        """The ids of distinct pieces, learnt where they are new."""
        at = pc.index_in(pieces, value_set=self.pieces)
        if at.null_count:
            learnt, ids = self._learn(pieces.filter(at.is_null()))
            self.pieces, self.ids = pa.concat_arrays([self.pieces, learnt]), pa.concat_arrays([self.ids, ids])
            at = pc.index_in(pieces, value_set=self.pieces)
        found = self.ids.take(at)
        if len(self.pieces) > MEMO_PIECES:
            self.pieces, self.ids = pieces, found
        return found

    def _by_parts(self, pieces: pa.Array) -> pa.Array:
        """The ids of distinct pieces; marks behind a word are looked up on their own."""
        both = pc.extract_regex(pieces, TAILED)
        one = both.is_null()
        heads, tails = (both.field(i).filter(pc.invert(one)) for i in (0, 1))
        if self.leading:
            tails = pc.binary_join_element_wise(pa.scalar(BARE, pa.large_string()), tails, pa.scalar("", pa.large_string()))
        parts = pa.concat_arrays([pieces.filter(one), heads, tails]).dictionary_encode()
        ids = self._known(parts.dictionary).take(parts.indices)
        n, k = len(pieces) - len(heads), len(heads)
        joined = pc.binary_join_element_wise(ids[n : n + k], ids[n + k :], pa.scalar(b"", pa.large_binary()))
        tailed = np.flatnonzero(~one.to_numpy(zero_copy_only=False))
        place = np.argsort(np.concatenate([np.setdiff1d(np.arange(n + k), tailed, assume_unique=True), tailed]))
        return pa.concat_arrays([ids[:n], joined]).take(pa.array(place))

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        out, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= CHARS_AT_ONCE:
                out += self._mixed(held)
                held, size = [], 0
        return out + self._mixed(held)

    def _mixed(self, texts: list[str]) -> list[bytes]:
        special = [i for i, t in enumerate(texts) if BARE in t or "<" in t and any(x in t or x in t.lower() for x in self.added)]
        if not special:
            return self._some(texts)
        out = self._some(["" if i in set(special) else t for i, t in enumerate(texts)])
        for i, ids in zip(special, self._encode([texts[i] for i in special]), strict=True):
            out[i] = ids
        return out

    def _ready(self, text: str) -> str:
        """A text whose pieces stand between spaces; single line ends are pieces too, or dropped."""
        if not self.leading:
            return text.lower().replace("\n", " ")
        return BARE + (text if "\n" not in text or "\n\n" in text or "\r" in text else text.replace("\n", f" {BARE}\n {BARE}"))

    def _harmed(self, pieces: pa.Array, piece: np.ndarray, ends: np.ndarray) -> list[int]:
        """The texts that are to be encoded whole."""

        def where(kind: str) -> np.ndarray:
            return np.flatnonzero(pc.match_substring_regex(pieces, kind).to_numpy(zero_copy_only=False)[piece])

        def text(at: np.ndarray) -> np.ndarray:
            return np.searchsorted(ends, at, "right") - 1

        if not self.leading:
            return np.unique(text(where(ODD))).tolist()
        alone, blank = where(f"^$|[{SPACES}]$"), where(f"^{BARE}$")
        line_end = pc.equal(pieces, f"{BARE}\n").to_numpy(zero_copy_only=False)
        alone = alone[(alone != ends[text(alone) + 1] - 1) & ~line_end[piece[alone]]]
        blank = blank[(blank != ends[text(blank) + 1] - 1) & (blank != ends[text(blank)])]
        opens = where(f"^{BARE}[{SPACES}]")
        return np.unique(text(np.concatenate([alone, blank, opens[~line_end[piece[opens]]]]))).tolist()

    def _some(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        lists = pc.split_pattern(pa.array([self._ready(t) for t in texts], pa.large_string()), " ")
        coded, ends = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
        ids = self._by_parts(coded.dictionary).take(coded.indices)
        raw = ids.buffers()[2].to_pybytes()
        cuts = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[ends].tolist()
        out = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        left = self._harmed(coded.dictionary, coded.indices.to_numpy(), ends)
        for i, found in zip(left, self._encode([texts[i] for i in left]), strict=True):
            out[i] = found
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder a worker and file, kept from task to task."""
    return PieceEncoder(path)
