"""N-gram Jaccard join as a blocked, masked product of the document by n-gram incidence matrix.

Rows are the distinct n-gram sets (documents with equal sets are one row), columns are 64-bit
n-gram hashes, dealt to column blocks by hash.

* Size bound on blocks: two rows at or above the threshold differ in at most
  (|x| + |y|) * (1 - t) / (1 + t) columns. With more column blocks than that, they agree in a
  whole block. So the rows of a size class are cut into that many blocks, and only pairs that agree
  in a block are candidates. A row also takes part in every class above in which a partner may be. Blocks that are
  empty count only for a row with more of them than there are blocks to spare.
* Product: the candidates' entries are multiplied block by block, overlap counts accumulate, and a
  pair goes once its count and what is left of its rows cannot reach the overlap its sizes need.
* Size bound on pairs: the parities of a row's entries by hash, 512 bits, differ between two rows in no
  more bits than the rows differ in entries; a pair with more than its sizes allow is never multiplied.
* Rows that agree in a block give a star: each is multiplied with one of them alone, and with those of
  its other blocks only if they are still apart. What the stars
  leave in several components goes on by groups. A group of at most FEW rows gives its pairs. In a
  larger one rows become differences to a centre, the entries that most of a few of its rows
  have, and the product of the differences has short columns: of two linked rows either both are
  so near to the centre that the row nearest to it links with both, or their differences share an
  entry, and one among as many first entries as linked rows of their sizes can differ in. So the
  nearest row gives a star, and each such column is a group in turn, of half the rows at most.
  No link is lost, whatever the centre, and no large group is ever multiplied with itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import OWN, as_bytes, cut, discard, released, stored, tidy, written
from terrane.llm._graph import components
from terrane.llm._sieve import Sieve
from terrane.session import shuffled

#: Words that a worker remembers, and rows that a task knows to have met: some 10 MB each at most.
MEMO_WORDS = 1 << 16
#: Rows of a group whose pairs are compared directly; a larger group gets a centre.
FEW = 256
#: Entries of sets that one multiplication of pairs sends at least, before it is done in parts.
LEAST_SENT = 1 << 22
#: Bytes of centres that are sent to all executors; all else that grows with the input is joined by merges, since
#: the planner goes by the bytes of compressed files, of which a twentieth of their rows' may be left.
MOST_SENT = 1 << 21
#: Rows that a group's centre is made of, about.
CENTRE_ROWS = 33
#: Rounds of centres; groups that are still apart then are compared directly, whatever their size.
ROUNDS = 12
COLUMN_BLOCKS = 4
#: Keys are told apart by a name of 44 bits, since candidates are compared whole; a task holds so many of them at once.
NAMES, HELD = 1 << 44, 1 << 21
#: Bytes that are kept of a hash until the rows with a partner are known.
SHORT = 5
#: Blocks in hundredths beyond the least number: a row with fewer empty blocks than are beyond needs none of them as a key.
SPARE = 15
BITS = [f"k{i}" for i in range(8)]
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def ngram_sets(texts: list[bytes | None], n: int, hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-word shingles; all words as one if there are fewer; empty without words."""
    get = hashes.__getitem__
    words = [np.fromiter(map(get, w), U, len(w)) for w in ((text or b"").lower().split() for text in texts)]  # bytes: only A-Z change, only ASCII white space splits
    ends = np.cumsum([len(w) for w in words]).tolist()
    all_texts = shingles(np.concatenate([*words, np.empty(0, U)]), n)  # at once; those across two texts are left out
    return [np.unique(all_texts[end - len(w) : end - n + 1] if len(w) >= n else shingles(w, len(w))) for w, end in zip(words, ends, strict=True)]


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each place on, where there are as many."""
    if not 0 < k <= len(h):
        return np.empty(0, U)
    total = np.full(len(h) - k + 1, k, U)
    for i in range(k):
        total = mix(total + h[i : len(h) - k + 1 + i] + U(0x9E3779B97F4A7C15))
    return total


def class_starts(upto: int) -> np.ndarray:
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, -(-out[-1] * 3 // 2)))
    return np.array(out, np.int64)


STARTS = class_starts(1 << 40)


def most_apart(size_class: np.ndarray, num: int, den: int) -> np.ndarray:
    """Entries that two linked rows of at most the class's sizes can differ in."""
    return 2 * (STARTS[size_class + 1] - 1) * (den - num) // (den + num)


def blocks_of(size_class: np.ndarray, num: int, den: int) -> np.ndarray:
    """Column blocks of a class: more than two of its rows at the threshold can differ in, by some SPARE."""
    apart = most_apart(size_class, num, den)
    return apart + 1 + apart * SPARE // 100


def block_keys(sets: list[np.ndarray], num: int, den: int) -> list[np.ndarray]:
    """For each set, one 64-bit key for each column block, of its class and of the further ones where a partner may be."""
    sizes = np.array([len(s) for s in sets], np.int64)
    own = np.searchsorted(STARTS, np.maximum(sizes, 1), "right") - 1
    flat = np.concatenate([*sets, np.empty(0, U)])
    row = np.repeat(np.arange(len(sets)), sizes)
    out: list[list[np.ndarray]] = [[] for _ in sets]
    for step in range(len(STARTS) - 1):
        cls = np.minimum(own + step, len(STARTS) - 2)
        takes = (sizes > 0) & (own + step == cls) & ((sizes * den >= STARTS[cls] * num) if step else True)
        if not takes.any():
            break
        m = np.where(takes, blocks_of(cls, num, den), 0)
        base = np.concatenate([[0], np.cumsum(m)])
        sums = np.zeros(base[-1], U)
        mine = takes[row]
        h, r = flat[mine], row[mine]
        at = base[r] + ((h >> U(32)) * m[r].astype(U) >> U(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        if len(first):
            sums[at[first]] = np.add.reduceat(mix(h ^ U(0xA5A5A5A5A5A5A5A5)), first)
        part = np.arange(base[-1]) - np.repeat(base[:-1], m)
        keys = mix(sums + mix(part.astype(U) * U(0x9E3779B97F4A7C15) + np.repeat(cls, m).astype(U)))
        # Linked rows agree in at least m - apart blocks. If fewer of a row's blocks are empty, one that is not agrees.
        filled = np.zeros(base[-1], bool)
        filled[at] = True
        owner = np.repeat(np.arange(len(sets)), m)
        empty = np.bincount(owner[~filled], minlength=len(sets))
        counts = filled | (empty >= m - most_apart(cls, num, den))[owner]
        for i in np.flatnonzero(takes):
            mine = slice(base[i], base[i + 1])
            out[i].append(keys[mine][counts[mine]])
    return [np.concatenate([*x, np.empty(0, U)]) for x in out]


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set 512 bits: the parity of its entries by hash. Two sets differ in at least as many entries as bits."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = owner * 512 + (np.concatenate([*sets, np.empty(0, U)]) & U(511)).astype(np.int64)
    odd = np.bincount(at, minlength=512 * len(sets)).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).reshape(len(sets), len(BITS))


def least_overlap(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """The overlap that sizes a and b need: den * o >= num * (a + b - o)."""
    return -(-num * (a + b) // (num + den))


def masked_product(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Whether each pair of rows reaches the threshold, by overlap counts over column blocks."""
    a, b = (np.array([len(s) for s in x], np.int64) for x in (left, right))
    need, count = least_overlap(a, b, num, den), np.zeros(len(a), np.int64)
    alive = np.minimum(a, b) >= need
    cuts = [U(k << 62) for k in range(1, COLUMN_BLOCKS)]
    edges = [[np.array([0, *np.searchsorted(s, cuts), len(s)]) for s in x] for x in (left, right)]
    for k in range(COLUMN_BLOCKS):
        pairs = np.flatnonzero(alive)
        if not len(pairs):
            break
        flat, owner = [], []
        for sets, ends in ((left, edges[0]), (right, edges[1])):
            parts = [sets[i][ends[i][k] : ends[i][k + 1]] for i in pairs]
            flat.append(np.concatenate(parts))
            owner.append(np.repeat(np.arange(len(pairs)), [len(p) for p in parts]))
        _, column = np.unique(np.concatenate(flat), return_inverse=True)
        width = int(column.max(initial=0)) + 1
        entries = np.concatenate(owner) * width + column
        x, y = entries[: len(flat[0])], entries[len(flat[0]) :]
        both = np.intersect1d(x, y, assume_unique=True) // width
        count[pairs] += np.bincount(both, minlength=len(pairs))
        rest = [np.array([e[i][-1] - e[i][k + 1] for i in pairs]) for e in edges]
        alive[pairs] = count[pairs] + np.minimum(*rest) >= need[pairs]
    return alive & (count >= need)


def sketch(entries: np.ndarray) -> bytes:
    """The parity of a set's entries by hash, in two to four bits an entry, 512 at least: it bounds where ``parities`` is full."""
    bits = max(512, 2 << int(len(entries)).bit_length())
    odd = np.bincount((entries & U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ, the longer one folded to the length of the other: no more than their sets do in entries."""
    x, y = (np.frombuffer(s, U) for s in (a, b))
    size = min(len(x), len(y))  # both are powers of two
    x, y = (np.bitwise_xor.reduce(s.reshape(-1, size), axis=0) for s in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def shortened(entries: np.ndarray) -> bytes:
    """The first SHORT bytes of each hash of a sorted set, as differences; as many as there are entries, also if some become equal."""
    steps = np.diff(entries >> U(64 - 8 * SHORT), prepend=U(0))
    return steps.view(np.uint8).reshape(-1, 8)[:, :SHORT].tobytes()


def lengthened(blob) -> np.ndarray:
    """The sorted hashes of ``shortened``, with zeros in place of what was left out.

    Two sets differ in no more of them than in whole ones, so rows that must agree in a block still do.
    """
    steps = np.zeros((len(blob) // SHORT, 8), np.uint8)
    steps[:, :SHORT] = np.frombuffer(blob, np.uint8).reshape(-1, SHORT)
    return np.cumsum(steps.view(U).ravel(), dtype=U) << U(64 - 8 * SHORT)


def _sums(sets: list[np.ndarray], salt: int = 0) -> np.ndarray:
    return np.array([mix(s ^ U(salt)).sum(dtype=U) for s in sets], U).view(np.int64)


def _signatures(n: int):
    """A row's shortened set with its signatures. A set that a task has just had is left out, and so is its tag: equal sets need one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            sets = ngram_sets(as_bytes(batch, "text"), n, hashes)
            s1, s2 = _sums(sets), _sums(sets, 0x5555555555555555)
            if len(seen) > MEMO_WORDS:
                seen.clear()
            first = [len(s) > 0 and not (x in seen or seen.add(x)) for s, x in zip(sets, zip(s1.tolist(), s2.tolist(), map(len, sets)), strict=True)]
            tag = pa.array(batch.column(1).to_numpy(), pa.int64(), mask=~np.array(first, bool))
            short = pa.array([shortened(s) if f else None for s, f in zip(sets, first, strict=True)], pa.binary())
            bits = [pa.array(x) for x in parities(sets).T]
            yield pa.RecordBatch.from_arrays([batch.column(0), tag, batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(s1), pa.array(s2), *bits, short], ["doc_id", "tag", "digest", "n", "s1", "s2", *BITS, "short"])

    return run


def _dealt_keys(num: int, den: int, classes):
    """(slot, names, first, steps) of the sets of (tag, hashed tag, short) whose tag passes the sieve of the classes.

    All keys by 12 bits of their names; 32 further bits of each are one string, and the tags of their rows, which rise by little, are
    the first one and steps of a byte or two in another, since most keys occur once and meet none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, held, n = Sieve(classes.value), [], 0

        def dealt() -> pa.RecordBatch:
            names, tags = (np.concatenate([*x, np.empty(0, U)]) for x in (zip(*held, strict=True) if held else ((), ())))
            order = np.argsort((names >> U(32)).astype(np.uint16), kind="stable")
            names, tags = names[order], tags[order]
            slots, at = np.unique(names >> U(32), return_index=True)
            steps = np.diff(tags, prepend=U(0))
            steps[at] = 0
            widths = np.maximum.reduceat(steps, at).tolist() if len(at) else []
            low, ends = names.astype(np.uint32), [*at[1:].tolist(), len(names)]
            blobs = [(low[i:j].tobytes(), steps[i:j].astype(np.min_scalar_type(w)).tobytes()) for i, j, w in zip(at.tolist(), ends, widths, strict=False)]
            columns = [pa.array([x[k] for x in blobs], pa.binary()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), columns[0], pa.array(tags[at].view(np.int64)), columns[1]], ["slot", "names", "first", "steps"])

        for batch in batches:
            mine = np.flatnonzero(sieve.holds(batch.column(1).to_numpy()))
            short = batch.column(2)
            keys = block_keys([lengthened(short[i].as_buffer()) for i in mine.tolist()], num, den)
            tags = np.repeat(batch.column(0).to_numpy()[mine], [len(k) for k in keys]).view(U)
            held.append((np.concatenate([*keys, np.empty(0, U)]) & U(NAMES - 1), tags))
            n += len(tags)
            if n >= HELD:
                yield dealt()
                held, n = [], 0
        yield dealt()

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, row, pivot) of the names that more than one row has, the pivot being the least of them; of names alone, those that occur more than once.

    Strings come in order of their slots; slots are held until they are whole.
    """
    held: list[tuple[np.ndarray, ...]] = []

    def found(names: np.ndarray, *rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        ordered = np.sort(names)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not rows:
            yield pa.RecordBatch.from_arrays([pa.array(twice.view(np.int64))], ["key"])
        elif len(twice):
            mine = twice[np.minimum(np.searchsorted(twice, names), len(twice) - 1)] == names
            names, row = names[mine], rows[0][mine]
            order = np.lexsort((row, names))
            names, row = names[order], row[order]
            other = np.append(True, names[1:] != names[:-1])
            once = other | np.append(True, row[1:] != row[:-1])  # a row has a name once
            names, row, first = names[once], row[once], np.flatnonzero(other[once])
            n = np.diff(np.append(first, len(names)))
            met = np.repeat(n > 1, n)
            columns = [pa.array(x[met].view(np.int64)) for x in (names, row, np.repeat(row[first], n))]
            out = pa.RecordBatch.from_arrays(columns, ["key", "row", "pivot"])
            yield from (out.slice(i, MEMO_WORDS) for i in range(0, len(out), MEMO_WORDS))

    n = 0
    for batch in batches:
        parts = [np.frombuffer(x, np.uint32) for x in batch.column(1).to_pylist()]
        slot = np.repeat(batch.column(0).to_numpy().astype(U), [len(x) for x in parts])
        columns = [(slot << U(32)) | np.concatenate([*parts, np.empty(0, np.uint32)]).astype(U)]
        if batch.num_columns > 2:
            firsts = batch.column(2).to_numpy().view(U)
            steps = (np.frombuffer(x, f"<u{len(x) // len(p)}") for x, p in zip(batch.column(3).to_pylist(), parts, strict=True))
            columns.append(np.concatenate([*(f + np.cumsum(x, dtype=U) for f, x in zip(firsts, steps, strict=True)), np.empty(0, U)]))
        held.append(tuple(columns))
        n += len(slot)
        if n >= HELD:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            whole = (columns[0] >> U(32)) < columns[0][-1] >> U(32)
            if whole.any():
                yield from found(*(x[whole] for x in columns))
            held = [tuple(x[~whole] for x in columns)]
            n = len(held[0][0])
    if held:
        yield from found(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _wanted(n: int, table):
    """(node, ngrams, sketch, n) of the texts of (hashed row, text) whose row may be wanted; a set that a task has just had is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, hashes, seen = Sieve(table.value), WordHashes(), set()
        for batch in batches:
            batch = batch.filter(pa.array(sieve.holds(batch.column(0).to_numpy())))
            sets = ngram_sets(as_bytes(batch, "text"), n, hashes)
            if len(seen) > MEMO_WORDS:
                seen.clear()
            node = _sums(sets)
            first = np.array([not (x in seen or seen.add(x)) for x in node.tolist()], bool)
            sets = [s for s, f in zip(sets, first.tolist(), strict=True) if f]
            yield pa.RecordBatch.from_arrays([pa.array(node[first]), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([sketch(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())], ["node", "ngrams", "sketch", "n"])

    return run


def _near(num: int, den: int):
    """(a, b, entries of both) of the pairs whose sketches differ in no more bits than a linked pair of these sizes in entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.array([bits_apart(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], np.int64)
            both = batch.column(4).to_numpy()
            near = pa.array(apart * (num + den) <= both * (den - num))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(near) for i in (0, 1, 4)], ["a", "b", "entries"])

    return run


def _multiply(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(x, U) for x in batch.column(i).to_pylist()] for i in (2, 3))
            linked = pa.array(masked_product(left, right, num, den))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(linked), batch.column(1).filter(linked)], ["a", "b"])

    return run


def differences(centre: np.ndarray, row: np.ndarray, num: int, den: int) -> tuple[int, np.ndarray]:
    """How many entries two sorted sets differ in, and the first of them: as many as linked rows of this size can differ in, and one.

    Entries that the centre lacks come first, then those that the row lacks, each in order of hash.
    """
    own, lost = np.setdiff1d(row, centre, assume_unique=True), np.setdiff1d(centre, row, assume_unique=True)
    most = len(row) * (den - num) // num + 1
    return len(own) + len(lost), np.concatenate([own[:most], lost[: max(0, most - len(own))]])


def _centre(key, rows):
    sets = [np.frombuffer(x, U) for x in rows.column("ngrams").to_pylist()]
    entries, n = np.unique(np.concatenate(sets), return_counts=True)
    return pa.table({"g": pa.array([key[0].as_py()], pa.int64()), "centre": pa.array([entries[2 * n > len(sets)].tobytes()], pa.binary())})


def _columns(num: int, den: int):
    """For rows and their group's centre: the number of differences, and the first ones with their places after one of place -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, rows = ([np.frombuffer(x or b"", U) for x in batch.column(c).to_pylist()] for c in ("centre", "ngrams"))
            found = [differences(c, r, num, den) for c, r in zip(centres, rows, strict=True)]
            sizes = np.array([len(x) + 1 for _, x in found], np.int64)
            owner = pa.array(np.repeat(np.arange(len(found)), sizes))
            column = np.concatenate([y for _, x in found for y in (np.zeros(1, U), x)] or [np.empty(0, U)]).view(np.int64)
            place = np.concatenate([np.arange(k) - 1 for k in sizes] or [np.empty(0, np.int64)])
            apart = pa.array([d for d, _ in found], pa.int64()).take(owner)
            weight = pa.array([d * (num + den) - len(r) * (den - num) for (d, _), r in zip(found, rows, strict=True)], pa.int64()).take(owner)
            kept = [batch.column(c).take(owner) for c in ("g", "node", "comp")]
            yield pa.RecordBatch.from_arrays([*kept, apart, weight, pa.array(column), pa.array(place)], ["g", "node", "comp", "d", "w", "col", "place"])

    return run


def small_or_shuffled(df: DataFrame, blob: str) -> DataFrame:
    """``df`` for a join: sent to all executors only if its blobs have few bytes, counted and not estimated."""
    sent = df.agg(F.sum(F.octet_length(blob) + 16)).first()[0] or 0
    return F.broadcast(df) if sent <= MOST_SENT else shuffled(df)


def link_documents(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: components of links den * |x & y| >= num * |x | y|.

    Words are runs of other than ASCII white space, A-Z lower-cased; a set holds the distinct n-word
    shingles, or the one sequence of fewer words. Sets are compared by 64-bit hashes of their
    shingles. Documents without words (null, empty, blank) have no shingles, link with nothing and
    are components of their own. component_id is the smallest id reachable, the row's own included;
    null ids are never the smallest, and a component of null ids alone has null. Repeated rows are in one component. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("tag"), F.xxhash64(text).alias("digest"), text.alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {id_type}, tag long, digest long, n long, s1 long, s2 long, {', '.join(f'{k} long' for k in BITS)}, short binary"
    hashed, folder = written(rows.mapInArrow(tidy(_signatures(n)), columns), "ngram-rows")
    signed = stored(hashed.drop("short"), "ngram-signed")
    some = signed.where("n > 0")
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest"))
    classes = cut(some.groupBy("s1", "s2", "n").agg(first_row.alias("lead"), F.min("tag").alias("tag")))  # one document stands for an equal set
    leads = classes.select("s1", "s2", "n", F.col("lead.doc_id").alias("lead"), F.col("lead.digest").alias("digest"), "tag")
    tagged = hashed.where("tag is not null").select("tag", F.xxhash64("tag").alias("slot"), "short")
    dealt = tagged.mapInArrow(tidy(_dealt_keys(num, den, Sieve.of(leads, "tag").broadcast(spark))), "slot long, names binary, first long, steps binary")
    entries, entries_folder = written(dealt.repartition("slot").sortWithinPartitions("slot").mapInArrow(tidy(_repeated), "key long, row long, pivot long"), "ngram-entries")
    del dealt, tagged
    discard(spark, folder)
    released(spark)
    node = signed.where("tag is not null")  # a row that stands for none has its class's node all the same
    node = {c: shuffled(node.select(F.col("tag").alias(c), F.col("s1").alias(f"{c}_node"))) for c in ("row", "pivot")}
    met = cut(entries.join(node["row"], "row").join(node["pivot"], "pivot").select("key", F.col("row_node").alias("node"), F.col("pivot_node").alias("pivot")))
    del entries
    discard(spark, entries_folder)
    released(spark)
    wanted = cut(met.select("node").distinct().join(shuffled(leads.select(F.col("s1").alias("node"), "tag", "lead", "digest")), "node"))
    # Most rows have no partner, so texts are cut into words again rather than whole sets kept. Rows are told by id and text: docs may come in another order.
    asked = Sieve.of(wanted.select(F.xxhash64("lead", "digest").alias("slot")), "slot", raw=True).broadcast(spark)
    released(spark)
    again = docs.select(F.xxhash64(F.col(id_col), F.xxhash64(text)).alias("slot"), text.alias("text"))
    sets = stored(again.mapInArrow(tidy(_wanted(n, asked)), "node long, ngrams binary, sketch binary, n long"), "ngram-sets")
    lead = some.join(shuffled(wanted.select("tag")), "tag", "left_semi")
    rough = cut(lead.select(F.col("s1").alias("node"), "n", *BITS).dropDuplicates(["node"]))

    def side(c: str) -> DataFrame:
        return shuffled(rough.select(F.col("node").alias(c), *[F.col(x).alias(f"{c}{x}") for x in ("n", *BITS)]))

    def may_link(a: str, b: str):
        """No more differing bits than a linked pair of these sizes has differing entries; that also bounds the sizes."""
        apart = sum((F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in BITS), F.lit(0))
        sizes = F.least(f"{a}n", f"{b}n") * den >= F.greatest(f"{a}n", f"{b}n") * num
        return sizes & (apart * (num + den) <= (F.col(f"{a}n") + F.col(f"{b}n")) * (den - num))

    def sets_of(nodes: DataFrame) -> DataFrame:
        return Sieve.of(nodes, "node").keep(sets.select("node", "ngrams"), "node")  # before a join shuffles the sets

    def with_sets(pairs: DataFrame) -> DataFrame:
        mine = sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
        a, b = (shuffled(mine.select(F.col("node").alias(c), F.col("ngrams").alias(f"{OWN}{c}"))) for c in "ab")
        return pairs.join(b, "b").join(a, "a").select("a", "b", f"{OWN}a", f"{OWN}b")

    def apart(cells: DataFrame, by: list[str]) -> DataFrame:
        """Cells whose rows are in more than one component, with their number of rows."""
        return cells.groupBy(*by).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi").drop("lo", "hi")

    def crossing(cells: DataFrame, by: list[str]) -> DataFrame:
        """Pairs of rows of one cell that may be linked and are not in one component: the one nearer to the centre by its first half."""
        mine = cells.join(shuffled(rough), "node")
        x = mine.where(F.col("place") * (2 * num) <= F.col("n") * (den - num)).select(*by, *[F.col(c).alias(f"a{c}") for c in ("comp", "d", "n", *BITS)], F.col("node").alias("a"))
        y = mine.select(*by, *[F.col(c).alias(f"b{c}") for c in ("comp", "d", "n", *BITS)], F.col("node").alias("b"))
        ordered = (F.col("ad") < F.col("bd")) | ((F.col("ad") == F.col("bd")) & (F.col("a") < F.col("b")))
        met = x.join(y, by).where(ordered & (F.col("acomp") != F.col("bcomp")) & may_link("a", "b"))
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    total = rough.agg(F.sum("n")).first()[0] or 0
    most = max(LEAST_SENT, total // 2)

    def in_parts(df: DataFrame, sent: int, by: list[str], name: str, job) -> DataFrame:
        """What the job makes of df's rows, in parts that send no more than half of all sets each, about; a part's shuffle files go before the next."""
        parts, out = max(1, -(-sent // most)), None
        for i in range(parts):
            mine = df.where(F.pmod(F.xxhash64(*by), F.lit(parts)) == i) if parts > 1 else df
            found = stored(job(mine), name)
            out = found if out is None else out.union(found)
            if parts > 1:
                released(spark)
        return out

    def tied(pairs: DataFrame, comps: DataFrame | None) -> DataFrame:
        """Components of the links so far and of those among the pairs."""
        x, y = (shuffled(sets.select(F.col("node").alias(c), F.col("sketch").alias(f"{OWN}{c}"), F.col("n").alias(f"{c}n"))) for c in "ab")
        both = pairs.join(y, "b").join(x, "a").where(F.least("an", "bn") * den >= F.greatest("an", "bn") * num)
        both = both.select("a", "b", f"{OWN}a", f"{OWN}b", (F.col("an") + F.col("bn")).alias("entries"))
        listed = stored(both.mapInArrow(tidy(_near(num, den)), "a long, b long, entries long"), "ngram-pairs")
        sent = listed.agg(F.sum("entries")).first()[0] or 0
        if not sent and comps is not None:
            return comps
        links = in_parts(listed, sent, ["a", "b"], "ngram-links", lambda mine: with_sets(mine).mapInArrow(tidy(_multiply(num, den)), "a long, b long"))
        return components(links if comps is None else links.union(comps.select("node", "comp")))

    # A row meets the least of its stars first; the others only if that has left the two apart.
    stars = met.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = stored(stars.join(side("a"), "a").join(side("b"), "b").where(may_link("a", "b")).select("a", "b"), "ngram-stars")
    comps = tied(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), None)
    released(spark)
    at = {c: shuffled(comps.select(F.col("node").alias(c), F.col("comp").alias(f"{c}comp"))) for c in "ab"}
    far = stars.join(at["a"], "a", "left").join(at["b"], "b", "left").where(F.coalesce("acomp", "a") != F.coalesce("bcomp", "b"))
    comps = tied(far.select("a", "b"), comps)
    # A block of few rows is a group; those of more become one group with others of the same crowd: a
    # large block's name is the least that any of its rows has from a large block.
    crowded = cut(met.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > FEW).select("key"))
    hot = met.join(crowded, "key")
    least = hot.groupBy("node").agg(F.min("pivot").alias("name"))
    names = hot.join(least, "node").groupBy("key").agg(F.min("name").alias("g"))
    groups = met.join(crowded, "key", "left_anti").select(F.col("key").alias("g"), "node").union(hot.join(names, "key").select("g", "node").distinct())
    groups = stored(groups, "ngram-groups")  # a round reads them twice
    del crowded, hot, least, names  # and their shuffle files
    for rounds in count():
        released(spark)
        placed = groups.join(shuffled(comps), "node", "left").select("g", "node", F.coalesce("comp", "node").alias("comp"))
        still = stored(placed.join(apart(placed, ["g"]), "g"), "ngram-apart")
        if not still.take(1):
            break
        small = still if rounds >= ROUNDS else still.where(F.col("m") <= FEW)
        cells = small.select("g", *(F.lit(0).cast("long").alias(c) for c in ("col", "d", "place")), "node", "comp")
        large, nearest = still.where(F.col("m") > FEW), None
        groups = still.select("g", "node").limit(0)
        if rounds < ROUNDS and large.take(1):
            some = large.where(F.pmod(F.xxhash64("node"), "m") < CENTRE_ROWS).select("g", "node")
            centres = some.join(shuffled(sets_of(some)), "node").select("g", "ngrams").groupBy("g").applyInArrow(_centre, "g long, centre binary")
            centres = small_or_shuffled(stored(centres, "ngram-centres"), "centre")

            def cells_of(mine: DataFrame, centres: DataFrame = centres) -> DataFrame:
                rows_there = mine.select("g", "node", "comp").join(shuffled(sets_of(mine)), "node").join(centres, "g", "left")
                return rows_there.mapInArrow(tidy(_columns(num, den)), "g long, node long, comp long, d long, w long, col long, place long")

            placed = in_parts(large, total, ["node"], "ngram-cells", cells_of)
            nearest = placed.where("place < 0").groupBy("g").agg(F.min_by(F.struct("node", "comp"), F.struct("w", "node")).alias("near"))
            nearest = large.join(shuffled(nearest), "g").where("near.node <> node and near.comp <> comp").select(F.least("near.node", "node").alias("a"), F.greatest("near.node", "node").alias("b"))
            placed = placed.where("place >= 0")
            parts = stored(placed.join(shuffled(apart(placed, ["g", "col"])), ["g", "col"]), "ngram-cells")
            cells = cells.unionByName(parts.where(F.col("m") <= FEW).select(*cells.columns))
            groups = stored(parts.where(F.col("m") > FEW).select(F.xxhash64("g", "col").alias("g"), "node").distinct(), "ngram-groups")
        pairs = crossing(cells, ["g", "col"])
        pairs = (pairs if nearest is None else pairs.union(nearest)).distinct()
        comps = tied(pairs, comps)
    named = leads.select("s1", "s2", "n", "lead").join(shuffled(comps.withColumnRenamed("node", "s1")), "s1", "left").withColumn("comp", F.coalesce("comp", "s1"))
    smallest = named.groupBy("comp").agg(F.min("lead").alias("component_id"))
    named = named.join(smallest, "comp").select("s1", "s2", "n", "component_id")
    out = signed.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
