"""Binary entity files (blobs of delta-coded protocol buffer blocks) as a Spark data source and sink.

A folder or file is read in byte ranges: a range begins at the first blob header at or behind its start and goes on to
the end of the blob in which it stops, so no task and no driver walks a whole file. A block becomes one Arrow batch; its numbers are decoded
as arrays. Tasks write files of their own, which appear when the job commits.

Defined results: absent versions, times, users and change sets are null, and so is -1, which stands for none where a dense
block must give a number; null maps, arrays and roles are written as empty ones, tags with a null value are left out; times have milliseconds. A
null id, null coordinates, an entry without id or a row of more than 32 MB cannot be written and raise. An empty table gives files with a header only. Columns other than
those of the kind are not written.
"""

from __future__ import annotations

import lzma
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

ENVELOPE = "id long, version int, user_id int, tstamp timestamp, changeset_id long, tags map<string,string>"
SCHEMAS = {
    "node": f"{ENVELOPE}, lat_e7 long, lon_e7 long",
    "way": f"{ENVELOPE}, nodes array<long>",
    "relation": f"{ENVELOPE}, members array<struct<type:string,id:long,role:string>>",
}
#: Bytes of a file that one task reads.
SPLIT_BYTES = 64 << 20
#: Entities of a block; a block with over SOFT_BYTES is halved.
BLOCK_ROWS = 8000

# Fixed values of the format.
SOFT_BYTES, MOST_BYTES, HEADER_BYTES = 16 << 20, 32 << 20, 64 << 10
KNOWN_FEATURES = {b"OsmSchema-V0.6", b"DenseNodes"}
MEMBER_TYPES = ["node", "way", "relation"]
GROUP_FIELD = {"node": 1, "dense": 2, "way": 3, "relation": 4}


# Numbers ---------------------------------------------------------------------------------------------------

def pack(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Varints of 64-bit numbers, and where each begins (and the end)."""
    v = np.ascontiguousarray(values, np.int64).view(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << (7 * k))
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(at[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        more = np.where(size[has] > k + 1, 128, 0).astype(np.uint64)
        out[at[:-1][has] + k] = ((v[has] >> np.uint64(7 * k)) & np.uint64(127)) | more
    return out.tobytes(), at


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of packed varints, and the byte at which each ends."""
    b = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(b < 128) + 1
    if not len(ends):
        if len(b):
            raise ValueError("a varint without end")
        return np.empty(0, np.int64), ends
    starts = np.concatenate([[0], ends[:-1]])
    if ends[-1] != len(b) or (ends - starts).max() > 10:
        raise ValueError("a varint without end")
    shift = (np.arange(len(b)) - np.repeat(starts, ends - starts)).astype(np.uint64) * np.uint64(7)
    return np.bitwise_or.reduceat((b & 127).astype(np.uint64) << shift, starts).view(np.int64), ends


def zigzag(v: np.ndarray) -> np.ndarray:
    v = np.asarray(v, np.int64)
    return (v << 1) ^ (v >> 63)


def unzigzag(v: np.ndarray) -> np.ndarray:
    u = v.view(np.uint64)
    return (u >> np.uint64(1)).view(np.int64) ^ -(v & 1)


def deltas(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Differences to the number before, anew in each list that begins at one of ``at``."""
    out = np.diff(v, prepend=0)
    first = at[:-1][np.diff(at) > 0]
    out[first] = v[first]
    return out


def sums(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The inverse of deltas."""
    total = np.cumsum(v)
    sizes = np.diff(at)
    some = sizes > 0
    first = at[:-1][some]
    return total - np.repeat(total[first] - v[first], sizes[some])


# Messages --------------------------------------------------------------------------------------------------

def fields(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(number, start, stop, value) of a message's fields; the value of a length-delimited one is its length."""
    def varint(at):
        value = shift = 0
        while True:
            if at >= end or shift > 63:
                raise ValueError("a message is cut")
            value |= (data[at] & 127) << shift
            at += 1
            if data[at - 1] < 128:
                return value, at
            shift += 7

    while at < end:
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, stop = varint(at)
        elif kind == 2:
            value, at = varint(at)
            stop = at + value
        elif kind in (1, 5):
            value, stop = 0, at + (8 if kind == 1 else 4)
        else:
            raise ValueError(f"wire type {kind}")
        if stop > end:
            raise ValueError("a message is cut")
        yield key >> 3, at, stop, value
        at = stop


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def small(value: int) -> bytes:
    """One varint."""
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def number(field: int, value: int) -> bytes:
    return small(field << 3) + small(value)


def piece(field: int, data: bytes) -> bytes:
    return small(field << 3 | 2) + small(len(data)) + data


# Reading ---------------------------------------------------------------------------------------------------

def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, also of file:/x with one slash."""
    if path.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def inflate(blob: bytes) -> bytes:
    size = None
    for n, start, stop, value in fields(blob, 0, len(blob)):
        if n == 1:
            return blob[start:stop]
        if n == 2:
            size = value
        elif n == 3:
            out = zlib.decompress(blob[start:stop])
        elif n == 4:
            out = lzma.decompress(blob[start:stop])
        else:
            raise ValueError(f"compression {n} is not known")
    if size is not None and size != len(out):
        raise ValueError("a blob of another size than it says")
    return out


@dataclass
class Header:
    at: int
    kind: bytes
    body: int
    size: int


def header(file, at: int, size: int) -> Header | None:
    """The blob header at a place, None if there is none."""
    if at + 4 > size:
        return None
    file.seek(at)
    length = int.from_bytes(file.read(4), "big")
    if not 0 < length <= HEADER_BYTES or at + 4 + length > size:
        return None
    data = file.read(length)
    kind, body = b"", -1
    try:
        for n, start, stop, value in fields(data, 0, length):
            kind, body = (data[start:stop], body) if n == 1 else (kind, value if n == 3 else body)
    except ValueError:
        return None
    begin = at + 4 + length
    return Header(at, kind, begin, body) if kind and 0 <= body <= MOST_BYTES + HEADER_BYTES and begin + body <= size else None


def first_header(file, start: int, stop: int, size: int) -> int | None:
    """Where the first data blob of a byte range begins: a header with another header or the file's end behind its blob."""
    mark, step = b"\x0a\x07OSMData", 1 << 20
    at = start
    while at < stop:
        file.seek(at)
        chunk = file.read(min(step, size - at))
        i = chunk.find(mark)
        while i >= 0:
            place = at + i - 4
            if place >= stop:
                return None
            found = header(file, place, size) if place >= start else None
            if found and (found.body + found.size == size or header(file, found.body + found.size, size)):
                return place
            i = chunk.find(mark, i + 1)
        if len(chunk) < step:
            return None
        at += step - len(mark) - 4
    return None


def blobs(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(place, kind, data) of the blobs that begin in a byte range."""
    fs, name = file_system(path)
    with fs.open_input_file(name) as file:
        size = file.size()
        at = 0 if start == 0 else first_header(file, start, stop, size)
        while at is not None and at < min(stop, size):
            found = header(file, at, size)
            if found is None:
                raise ValueError(f"{path}: no blob at byte {at}")
            file.seek(found.body)
            if found.kind in (b"OSMData", b"OSMHeader"):
                try:
                    yield at, found.kind, inflate(file.read(found.size))
                except (zlib.error, lzma.LZMAError, ValueError) as e:
                    raise ValueError(f"{path}: damaged blob at byte {at}: {e}") from e
            at = found.body + found.size


class Lists:
    """Packed lists of many messages, decoded at once."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.ends: list[int] = []
        self.size = 0

    def add(self, part: bytes) -> None:
        self.parts.append(part)
        self.size += len(part)

    def close(self) -> None:
        self.ends.append(self.size)

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, and where each message's begin (and the end)."""
        values, stops = unpack(b"".join(self.parts))
        return values, np.concatenate([[0], np.searchsorted(stops, self.ends, "right")]).astype(np.int64)


@dataclass
class Block:
    """What all groups of a block share."""

    strings: pa.Array
    grain: int = 100
    time_grain: int = 1000
    lat: int = 0
    lon: int = 0

    def tags(self, keys: np.ndarray, values: np.ndarray, at: np.ndarray) -> pa.Array:
        return pa.MapArray.from_arrays(pa.array(at, pa.int32()), self.strings.take(pa.array(keys)), self.strings.take(pa.array(values)))

    def envelope(self, ids, version, uid, stamp, changeset) -> list[pa.Array]:
        none = lambda v, kind: pa.array(v, kind, mask=v == -1)
        micros = pa.array(np.where(stamp == -1, 0, stamp * self.time_grain * 1000), pa.int64(), mask=stamp == -1).cast(pa.timestamp("us", "UTC"))
        return [pa.array(ids, pa.int64()), none(version, pa.int32()), none(uid, pa.int32()), micros, none(changeset, pa.int64())]

    def degrees(self, lat: np.ndarray, lon: np.ndarray) -> list[pa.Array]:
        return [pa.array((self.lat + self.grain * lat + 50) // 100), pa.array((self.lon + self.grain * lon + 50) // 100)]


def dense_nodes(block: Block, data: bytes, at: int, end: int) -> list[pa.Array]:
    got, info = {}, {}
    for n, start, stop, _ in fields(data, at, end):
        if n == 5:
            for m, s, e, _ in fields(data, start, stop):
                info[m] = info.get(m, b"") + data[s:e]
        else:
            got[n] = got.get(n, b"") + data[start:stop]
    run = lambda b: np.cumsum(unzigzag(unpack(b)[0]))
    ids = run(got.get(1, b""))
    given = lambda m, read: read(info[m]) if info.get(m) else np.full(len(ids), -1, np.int64)
    pairs, _ = unpack(got.get(10, b""))
    if len(pairs):
        # A key is never 0, but a value can be the empty string 0: ends stand where a key is due.
        odd = np.zeros(len(pairs), bool)
        zeros, due = np.flatnonzero(pairs == 0), 0
        for z in zeros:
            if (z - due) % 2 == 0:
                odd[z] = True
                due = z + 1
        ends = np.flatnonzero(odd)
        kv = pairs[~odd]
        tag_at = np.concatenate([[0], (ends - np.arange(len(ends))) // 2])
    else:
        kv, tag_at = pairs, np.zeros(len(ids) + 1, np.int64)
    envelope = block.envelope(ids, given(1, lambda b: unpack(b)[0]), given(4, run), given(2, run), given(3, run))
    return [*envelope, block.tags(kv[::2], kv[1::2], tag_at), *block.degrees(run(got.get(8, b"")), run(got.get(9, b"")))]


def entity_rows(block: Block, kind: str, data: bytes, messages: list[tuple[int, int]]) -> list[pa.Array]:
    """Plain nodes, ways or relations, a message each."""
    lists = {n: Lists() for n in (2, 3, *{"node": (), "way": (8,), "relation": (8, 9, 10)}[kind])}
    ids, infos, places = [], [], []
    for at, end in messages:
        own, info, place = 0, [-1] * 5, [0, 0]
        for n, start, stop, value in fields(data, at, end):
            if n == 1:
                own = value
            elif n == 4:
                for m, _, _, v in fields(data, start, stop):
                    if m < 5:
                        info[m] = signed(v)
            elif n in lists:
                lists[n].add(data[start:stop])
            elif kind == "node" and n in (8, 9):
                place[n - 8] = value
        for one in lists.values():
            one.close()
        ids.append(signed(own))
        infos.append(info)
        places.append([signed(p) for p in place])
    number_of = np.array(infos, np.int64).reshape(-1, 5)
    own = np.array(ids, np.int64)
    read = {n: one.read() for n, one in lists.items()}
    (keys, tag_at), (values, _) = read[2], read[3]
    first = [*block.envelope(unzigzag(own) if kind == "node" else own, number_of[:, 1], number_of[:, 4], number_of[:, 2], number_of[:, 3]), block.tags(keys, values, tag_at)]
    if kind == "node":
        both = unzigzag(np.array(places, np.int64).reshape(-1, 2).ravel()).reshape(-1, 2)
        return [*first, *block.degrees(both[:, 0], both[:, 1])]
    if kind == "way":
        refs, at = read[8]
        return [*first, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sums(unzigzag(refs), at), pa.int64()))]
    (roles, at), (refs, _), (types, _) = read[8], read[9], read[10]
    rows = pa.StructArray.from_arrays([pa.array(MEMBER_TYPES).take(pa.array(types)), pa.array(sums(unzigzag(refs), at), pa.int64()), block.strings.take(pa.array(roles))], ["type", "id", "role"])
    return [*first, pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)]


def block_rows(data: bytes, kind: str) -> Iterator[list[pa.Array]]:
    """Columns of the entities of one kind, a list of arrays for each group of a block."""
    shared = {17: 100, 18: 1000, 19: 0, 20: 0}
    groups, strings = [], []
    for n, start, stop, value in fields(data, 0, len(data)):
        if n == 1:
            strings = [data[s:e] for m, s, e, _ in fields(data, start, stop) if m == 1]
        elif n == 2:
            groups.append((start, stop))
        elif n in shared:
            shared[n] = signed(value)
    block = Block(pa.array([s.decode("utf-8", "replace") for s in strings], pa.string()), *shared.values())
    for at, end in groups:
        plain = []
        for n, start, stop, _ in fields(data, at, end):
            if n == GROUP_FIELD["dense"] and kind == "node":
                yield dense_nodes(block, data, start, stop)
            elif n == GROUP_FIELD[kind]:
                plain.append((start, stop))
        if plain:
            yield entity_rows(block, kind, data, plain)


def check_header(data: bytes) -> None:
    for n, start, stop, _ in fields(data, 0, len(data)):
        if n == 4 and data[start:stop] not in KNOWN_FEATURES:
            raise ValueError(f"required feature {data[start:stop].decode()} is not known")


@dataclass
class Split(InputPartition):
    path: str
    start: int
    stop: int


class PbfReader(DataSourceReader):
    def __init__(self, path: str, kind: str, names: list[str], split: int) -> None:
        self.path, self.kind, self.names, self.split = path, kind, names, split

    def partitions(self) -> list[Split]:
        fs, name = file_system(self.path)
        info = fs.get_file_info(name)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(name))
        files = sorted((f.path, f.size) for f in files if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))
        prefix = self.path.split("://")[0] + "://" if "://" in self.path and not self.path.startswith("file:") else ""
        return [Split(prefix + p, s, min(s + self.split, size)) for p, size in files for s in range(0, size, self.split)] or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        for at, kind, data in blobs(partition.path, partition.start, partition.stop):
            if kind == b"OSMHeader":
                check_header(data)
                continue
            try:
                for columns in block_rows(data, self.kind):
                    yield pa.RecordBatch.from_arrays(columns, self.names)
            except (ValueError, IndexError, pa.ArrowInvalid) as e:
                raise ValueError(f"{partition.path}: damaged block at byte {at}: {e}") from e


# Writing ---------------------------------------------------------------------------------------------------

def framed(kind: bytes, data: bytes) -> bytes:
    blob = number(2, len(data)) + piece(3, zlib.compress(data))
    head = piece(1, kind) + number(3, len(blob))
    return len(head).to_bytes(4, "big") + head + blob


def flat(column: pa.Array, *children: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """Where each row's entries begin, from 0, and the children's entries."""
    at = np.asarray(column.offsets, np.int64)
    return at - at[0], [c.slice(at[0], at[-1] - at[0]) for c in children]


def coded(*columns: pa.Array) -> tuple[list[bytes], list[np.ndarray]]:
    """A string table, which begins with the empty string, and numbers into it."""
    together = pa.concat_arrays([c.cast(pa.string()) for c in columns]).dictionary_encode()
    codes = np.asarray(together.indices, np.int64) + 1
    table = [b"", *(s.encode() for s in together.dictionary.to_pylist())]
    return table, np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).fill_null(-1), np.int64)


def block_bytes(batch: pa.RecordBatch, kind: str) -> bytes:
    """The block of a batch without nulls but in the envelope."""
    own = ("id", "lat_e7", "lon_e7") if kind == "node" else ("id",)
    if any(batch.column(c).null_count for c in own):
        raise ValueError(f"a {kind} without {' or '.join(own)} cannot be written")
    ids, n = numbers(batch, "id"), batch.num_rows
    tags = batch.column("tags")
    tag_at, (keys, values) = flat(tags, tags.keys, tags.items)
    more, types = [], None
    if kind == "relation":
        members = batch.column("members")
        at, (entries,) = flat(members, members.values)
        types, refs, roles = entries.flatten()
        more = [roles]
    elif kind == "way":
        nodes = batch.column("nodes")
        at, (refs,) = flat(nodes, nodes.values)
    if kind != "node" and refs.null_count:
        raise ValueError(f"a {kind} with an entry without id cannot be written")
    table, codes = coded(keys, values, *more)
    micros = np.asarray(batch.column("tstamp").cast(pa.timestamp("us", "UTC")).cast(pa.int64()).fill_null(-1), np.int64)
    absent = np.asarray(batch.column("tstamp").is_null())
    grain = 1000 if not (micros[~absent] % 1_000_000).any() else 1
    stamp = np.where(absent, -1, micros // (grain * 1000))
    info = {1: numbers(batch, "version"), 2: stamp, 3: numbers(batch, "changeset_id"), 4: numbers(batch, "user_id")}
    if kind == "node":
        group = piece(2, dense_bytes(ids, info, codes, tag_at, numbers(batch, "lat_e7"), numbers(batch, "lon_e7")))
    else:
        lists = {2: (codes[0], tag_at), 3: (codes[1], tag_at)}
        places = zigzag(deltas(np.asarray(refs, np.int64), at))
        if kind == "way":
            lists[8] = (places, at)
        else:
            kinds = pc.index_in(types, pa.array(MEMBER_TYPES))
            if kinds.null_count:
                raise ValueError("a member that is no node, way or relation cannot be written")
            lists |= {8: (codes[2], at), 9: (places, at), 10: (np.asarray(kinds, np.int64), at)}
        packed = {f: (*pack(v), w) for f, (v, w) in lists.items()}
        rows = []
        for i in range(n):
            row = [number(1, int(ids[i]))]
            for f in (2, 3, 4, 8, 9, 10):
                if f == 4:
                    own_info = b"".join(number(m, int(v[i])) for m, v in info.items() if v[i] != -1)
                    row += [piece(4, own_info)] if own_info else []
                elif f in packed:
                    data, begins, where = packed[f]
                    mine = data[begins[where[i]] : begins[where[i + 1]]]
                    row += [piece(f, mine)] if mine else []
            rows.append(piece(GROUP_FIELD[kind], b"".join(row)))
        group = b"".join(rows)
    return piece(1, b"".join(piece(1, s) for s in table)) + piece(2, group) + number(18, grain)


def dense_bytes(ids, info, codes, tag_at, lat, lon) -> bytes:
    run = lambda v: pack(zigzag(np.diff(v, prepend=0)))[0]
    pairs = np.stack([codes[0], codes[1]], 1).ravel()
    pairs = np.insert(pairs, 2 * tag_at[1:], 0) if len(pairs) else pairs
    about = piece(1, pack(info[1])[0]) + b"".join(piece(m, run(info[m])) for m in (2, 3, 4)) if any((v != -1).any() for v in info.values()) else b""
    return piece(1, run(ids)) + (piece(5, about) if about else b"") + piece(8, run(lat)) + piece(9, run(lon)) + (piece(10, pack(pairs)[0]) if len(pairs) else b"")


@dataclass
class Written(WriterCommitMessage):
    name: str


class PbfWriter(DataSourceArrowWriter):
    def __init__(self, path: str, kind: str) -> None:
        self.path, self.kind, self.job = path, kind, uuid.uuid4().hex

    def _folder(self) -> str:
        return f"{file_system(self.path)[1].rstrip('/')}/_temporary-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, _ = file_system(self.path)
        name = f"{self.kind}-{uuid.uuid4().hex}.osm.pbf"
        fs.create_dir(self._folder(), recursive=True)
        with fs.open_output_stream(f"{self._folder()}/{name}", compression=None) as out:
            out.write(framed(b"OSMHeader", b"".join(piece(4, f) for f in sorted(KNOWN_FEATURES, reverse=True)) + piece(16, b"terrane")))
            for batch in iterator:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    self._blocks(out, batch.slice(at, BLOCK_ROWS))
        return Written(name)

    def _blocks(self, out, batch: pa.RecordBatch) -> None:
        data = block_bytes(batch, self.kind)
        if len(data) > SOFT_BYTES and batch.num_rows > 1:
            half = batch.num_rows // 2
            self._blocks(out, batch.slice(0, half))
            self._blocks(out, batch.slice(half))
        elif len(data) > MOST_BYTES:
            raise ValueError(f"{self.kind} {batch.column('id')[0]} takes more than {MOST_BYTES} bytes")
        else:
            out.write(framed(b"OSMData", data))

    def commit(self, messages: list) -> None:
        fs, name = file_system(self.path)
        for m in messages:
            if m:
                fs.move(f"{self._folder()}/{m.name}", f"{name.rstrip('/')}/{m.name}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        fs, _ = file_system(self.path)
        if fs.get_file_info(self._folder()).type == pafs.FileType.Directory:
            fs.delete_dir(self._folder())


class PbfSource(DataSource):
    """format("entity_pbf"), options path, kind (node, way, relation) and splitBytes; writes with mode append."""

    @classmethod
    def name(cls) -> str:
        return "entity_pbf"

    def _kind(self) -> str:
        kind = self.options.get("kind", "")
        if kind not in SCHEMAS:
            raise ValueError(f"kind must be one of {', '.join(SCHEMAS)}")
        return kind

    def schema(self) -> str:
        return SCHEMAS[self._kind()]

    def reader(self, schema) -> PbfReader:
        return PbfReader(self.options["path"], self._kind(), schema.names, int(self.options.get("splitbytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> PbfWriter:
        if overwrite:
            raise ValueError("binary entity files are appended to a folder, never overwritten")
        return PbfWriter(self.options["path"], self._kind())


def read_pbf(spark: SparkSession, path: str, kind: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Nodes, ways or relations of a binary entity file or a folder of them."""
    spark.dataSource.register(PbfSource)
    return spark.read.format("entity_pbf").option("kind", kind).option("splitBytes", split_bytes).load(path)


def write_pbf(entities: DataFrame, path: str, kind: str) -> None:
    """Entities in ranges of ids, sorted within each file; other kinds can be appended to the same folder."""
    entities.sparkSession.dataSource.register(PbfSource)
    filled = {
        "tags": F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull()) if "tags" in entities.columns else F.create_map(),
        "nodes": F.coalesce("nodes", F.array().cast("array<long>")) if kind == "way" else None,
        "members": F.transform(F.coalesce("members", F.array().cast("array<struct<type:string,id:long,role:string>>")), lambda m: F.struct(m["type"].alias("type"), m["id"].alias("id"), F.coalesce(m["role"], F.lit("")).alias("role"))) if kind == "relation" else None,
    }
    columns = []
    for field in StructType.fromDDL(SCHEMAS[kind]):
        value = filled.get(field.name)
        if value is None:
            value = F.col(field.name) if field.name in entities.columns else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    rows = entities.select(*columns).repartitionByRange("id").sortWithinPartitions("id")
    rows.write.format("entity_pbf").option("kind", kind).mode("append").save(path)
