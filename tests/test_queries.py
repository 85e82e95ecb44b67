"""Every registered query against DuckDB on the same tables, and the contract of the entry module."""

import os
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_module
from terrane import queries

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (float, np.floating)):
        return round(float(v), 4)
    return v


def rows(names, values):
    order = np.argsort(names)
    return sorted((tuple(str(plain(r[i])) for i in order) for r in values))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, DATA)
    cursor = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, map(tuple, got.collect())) == rows(names, cursor.fetchall())


def test_entry_contract(spark):
    assert entry_module.entry(spark).count() == 200
    assert set(queries.ORACLES) <= set(queries.QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_tiles_split_and_cover(spark):
    tiles = queries.QUERIES["kd_split"](spark, DATA)
    from terrane import views
    from terrane.operators import partition

    nodes = views.nodes(spark, DATA)
    placed = partition.assign(nodes, tiles, 100_000_000)
    assert placed.count() == nodes.count() == placed.select("id").distinct().count()
    assert tiles.count() >= 16
