"""Binary entity files: number coding, round trips with nulls, splits, foreign blocks and damage."""

import datetime as dt
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from terrane.sources import pbf

LONG = st.integers(-(2**63), 2**63 - 1)


@given(st.lists(LONG))
def test_numbers_round_trip(values):
    v = np.array(values, np.int64)
    data, at = pbf.pack(v)
    back, ends = pbf.unpack(data)
    assert (back == v).all() and (at[1:] == ends).all()
    assert (pbf.unzigzag(pbf.zigzag(v)) == v).all()


@given(st.lists(st.lists(LONG)))
def test_deltas_begin_anew_in_each_list(lists):
    v = np.array([x for one in lists for x in one], np.int64)
    at = np.cumsum([0, *map(len, lists)])
    assert (pbf.sums(pbf.deltas(v, at), at) == v).all()


ENVELOPE = "id long, version int, user_id int, tstamp timestamp, changeset_id long, tags map<string,string>"
T0 = dt.datetime(2020, 1, 2, 3, 4, 5)


def plain(df):
    return sorted((tuple(str(sorted(v.items()) if isinstance(v, dict) else v) for v in r) for r in df.collect()), key=lambda r: int(r[0]))


def rows(kind, n):
    own = {"node": lambda i: (i * 7 - 900, -i * 11), "way": lambda i: ([i * 3, 5, 2**40 - i][: i % 4],), "relation": lambda i: ([(pbf.MEMBER_TYPES[j % 3], i - j * 9, "ro\u00fcle" * (j % 2)) for j in range(i % 5)],)}[kind]
    tags = [{}, {"a": ""}, {"": "x", "name": "Stra\u00dfe;\n"}, {"a": "b", "k": "long" * 50}]
    return [(i * 3 - 50, *((None,) * 4 if i % 6 == 0 else (i, i * 2, T0 + dt.timedelta(seconds=i), i * 5)), tags[i % 4], *own(i)) for i in range(n)]


@pytest.mark.parametrize("kind", list(pbf.SCHEMAS))
@pytest.mark.parametrize("split", [97, 1 << 20])
def test_round_trip_in_any_splits(spark, tmp_path, kind, split, monkeypatch):
    df = spark.createDataFrame(rows(kind, 300), pbf.SCHEMAS[kind])
    path = str(tmp_path / "x")
    pbf.write_pbf(df.repartition(3), path, kind)
    assert not [f for f in Path(path).iterdir() if not f.name.endswith(".osm.pbf")]
    assert plain(pbf.read_pbf(spark, path, kind, split)) == plain(df)


def test_all_kinds_in_one_folder_and_none_of_a_kind(spark, tmp_path):
    path = str(tmp_path / "x")
    for kind in ("node", "way"):
        pbf.write_pbf(spark.createDataFrame(rows(kind, 20), pbf.SCHEMAS[kind]), path, kind)
    assert pbf.read_pbf(spark, path, "node").count() == pbf.read_pbf(spark, path, "way").count() == 20
    assert pbf.read_pbf(spark, path, "relation").count() == 0


def test_empty_table_nulls_and_other_columns(spark, tmp_path):
    pbf.write_pbf(spark.createDataFrame([], pbf.SCHEMAS["way"]), str(tmp_path / "empty"), "way")
    assert pbf.read_pbf(spark, str(tmp_path / "empty"), "way").count() == 0
    df = spark.createDataFrame([(1, None, None, 4), (1, {"a": None, "b": "c"}, [7, 7], 4)], "id long, tags map<string,string>, nodes array<long>, kind int")
    pbf.write_pbf(df, str(tmp_path / "nulls"), "way")
    got = pbf.read_pbf(spark, str(tmp_path / "nulls"), "way").orderBy(pbf.F.size("nodes")).collect()
    assert [(r.id, r.version, r.tstamp, r.tags, r.nodes) for r in got] == [(1, None, None, {}, []), (1, None, None, {"b": "c"}, [7, 7])]
    for bad, kind in ((spark.createDataFrame([(1, None, 2)], "id long, lat_e7 long, lon_e7 long"), "node"), (spark.createDataFrame([(1, [None])], "id long, nodes array<long>"), "way")):
        with pytest.raises(PySparkException, match="without"):
            pbf.write_pbf(bad, str(tmp_path / "bad"), kind)
    assert not list(tmp_path.glob("bad/*.pbf"))


def test_milliseconds_stay(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 0, 0, 0, 250000), 5, 6)], "id long, tstamp timestamp, lat_e7 long, lon_e7 long")
    pbf.write_pbf(df, str(tmp_path / "x"), "node")
    assert pbf.read_pbf(spark, str(tmp_path / "x"), "node").first().tstamp == df.first().tstamp


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(n, data):
    return varint(n << 3 | 2) + varint(len(data)) + data if isinstance(data, bytes) else varint(n << 3) + varint(data)


def framed(kind, data, raw=False):
    blob = field(1, data) if raw else field(2, len(data)) + field(3, zlib.compress(data))
    head = field(1, kind) + field(3, len(blob))
    return len(head).to_bytes(4, "big") + head + blob


def test_blocks_of_other_writers(spark, tmp_path):
    """Plain nodes, raw blobs, grain and offsets, an unknown blob, dense tags whose value is the empty string, and a mark within a text."""
    strings = field(1, b"") + field(1, b"k") + field(1, b"\x0a\x07OSMData")
    node = field(1, 6) + field(2, b"\x01") + field(3, b"\x02") + field(4, field(1, 9)) + field(8, 20) + field(9, 3)
    plain_block = field(1, strings) + field(2, field(1, node)) + field(17, 1000) + field(19, 500) + field(20, 0)
    dense = field(1, b"\x02\x02\x02") + field(8, b"\x02\x00\x00") + field(9, b"\x00\x00\x00") + field(10, b"\x01\x00\x00\x00\x01\x02\x00")
    dense_block = field(1, strings) + field(2, field(2, dense))
    file = tmp_path / "a.osm.pbf"
    file.write_bytes(framed(b"OSMHeader", field(4, b"OsmSchema-V0.6")) + framed(b"Other", b"zz") + framed(b"OSMData", plain_block, raw=True) + framed(b"OSMData", dense_block))
    for split in (1, 40, 10**6):
        got = pbf.read_pbf(spark, str(file), "node", split).collect()
        assert sorted((r.id, r.version, r.lat_e7, r.lon_e7, *r.tags.items()) for r in got if r.id != 3 or not r.version) == [(1, None, 1, 0, ("k", "")), (2, None, 1, 0), (3, None, 1, 0, ("k", "\n\x07OSMData"))]
        assert [(r.version, r.lat_e7, r.lon_e7, *r.tags.items()) for r in got if r.id == 3 and r.version] == [(9, 105, -20, ("k", "\n\x07OSMData"))]


def test_damage_and_unknown_features_are_told(spark, tmp_path):
    path = tmp_path / "x"
    pbf.write_pbf(spark.createDataFrame(rows("node", 50), pbf.SCHEMAS["node"]).coalesce(1), str(path), "node")
    file = max(path.glob("*.pbf"), key=lambda f: f.stat().st_size)
    data = bytearray(file.read_bytes())
    data[-20] ^= 1
    file.write_bytes(bytes(data))
    with pytest.raises(PySparkException, match="damaged blob at byte"):
        pbf.read_pbf(spark, str(path), "node").count()
    file.write_bytes(bytes(data[:-9]))
    with pytest.raises(PySparkException, match="no blob at byte"):
        pbf.read_pbf(spark, str(file), "node").count()
    file.write_bytes(framed(b"OSMHeader", field(4, b"HistoricalInformation")))
    with pytest.raises(PySparkException, match="HistoricalInformation"):
        pbf.read_pbf(spark, str(file), "node").count()
