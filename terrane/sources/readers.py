"""Readers and writers of the formats around the engine, all through Spark's own sources."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_polygon(text: str) -> tuple[str, list[list[tuple[int, int]]]]:
    """Name and rings of a clip polygon file, coordinates in 1e-7 degrees; a ring id with ! would be a hole."""
    rows = [x.strip() for x in text.splitlines() if x.strip()]
    name, rings, ring = rows[0], [], None
    for row in rows[1:]:
        if row.upper() == "END":
            if ring is None:
                return name, rings
            rings.append(ring)
            ring = None
        elif ring is None:
            ring = []
        else:
            lon, lat = map(float, row.split()[:2])
            ring.append((round(lon * 1e7), round(lat * 1e7)))
    if ring is not None:
        raise ValueError("a ring without END")
    return name, rings


def read_polygon(spark: SparkSession, path: str) -> tuple[str, list[list[tuple[int, int]]]]:
    return parse_polygon("\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect()))  # one small file


TAG = T.ArrayType(T.StructType([T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())]))
ENVELOPE = [T.StructField("_id", T.LongType()), T.StructField("_version", T.IntegerType()), T.StructField("_user", T.StringType()), T.StructField("_uid", T.IntegerType()), T.StructField("_timestamp", T.StringType()), T.StructField("_changeset", T.LongType()), T.StructField("tag", TAG)]
OWN = {
    "node": [T.StructField("_lat", T.StringType()), T.StructField("_lon", T.StringType())],
    "way": [T.StructField("nd", T.ArrayType(T.StructType([T.StructField("_ref", T.LongType())])))],
    "relation": [T.StructField("member", T.ArrayType(T.StructType([T.StructField(f"_{c}", t) for c, t in (("type", T.StringType()), ("ref", T.LongType()), ("role", T.StringType()))])))],
}


def read_entity_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Nodes, ways or relations of an entity XML file (plain, gzip or bzip2), with a given schema."""
    return _entities(spark.read.format("xml").schema(T.StructType([*ENVELOPE, *OWN[kind]])).option("rowTag", kind).load(path), kind)


def _entities(raw: DataFrame, kind: str) -> DataFrame:
    pairs = F.coalesce(F.transform("tag", lambda t: F.struct(t["_k"], t["_v"])), F.array().cast("array<struct<_k:string,_v:string>>"))
    tags = F.map_from_entries(pairs)
    base = [F.col("_id").alias("id"), F.col("_version").alias("version"), F.col("_uid").alias("user_id"), F.to_timestamp("_timestamp").alias("tstamp"), F.col("_changeset").alias("changeset_id"), tags.alias("tags")]
    if kind == "node":
        more = [F.round(F.col("_lat").cast("decimal(20,10)") * 10000000).cast("long").alias("lat_e7"), F.round(F.col("_lon").cast("decimal(20,10)") * 10000000).cast("long").alias("lon_e7")]
    elif kind == "way":
        more = [F.coalesce(F.col("nd._ref"), F.array().cast("array<long>")).alias("nodes")]
    else:
        more = [F.transform("member", lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("id"), m["_role"].alias("role"))).alias("members")]
    return raw.select(*base, *more)


def _xml_rows(entities: DataFrame, kind: str) -> list[Column]:
    """Columns of an entity as the XML writer takes them: attributes, tags in order of key, and what is its kind's own."""
    pairs = F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.struct(e["key"].alias("_k"), e["value"].alias("_v")))
    kept = [F.col(c).cast("string").alias(a) for c, a in (("version", "_version"), ("user_id", "_uid"), ("changeset_id", "_changeset")) if c in entities.columns]
    if "tstamp" in entities.columns:
        kept.append(F.date_format("tstamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("_timestamp"))
    degrees = lambda c: F.format_string("%s%d.%07d", F.when(F.col(c) < 0, "-").otherwise(""), F.expr(f"abs({c}) div 10000000"), F.abs(F.col(c)) % 10000000)
    if kind == "node":
        own = [degrees("lat_e7").alias("_lat"), degrees("lon_e7").alias("_lon")]
    elif kind == "way":
        own = [F.transform("nodes", lambda n: F.struct(n.alias("_ref"))).alias("nd")]
    else:
        own = [F.transform("members", lambda m: F.struct(m["type"].alias("_type"), m["id"].alias("_ref"), m["role"].alias("_role"))).alias("member")]
    return [F.col("id").alias("_id"), *kept, *own, pairs.alias("tag")]


def write_entity_xml(entities: DataFrame, path: str, kind: str) -> None:
    """Nodes, ways or relations as entity XML, coordinates with seven decimals."""
    entities.select(*_xml_rows(entities, kind)).write.format("xml").option("rootTag", "entities").option("rowTag", kind).save(path)


def write_node_xml(nodes: DataFrame, path: str) -> None:
    """Nodes as entity XML with seven decimals."""
    write_entity_xml(nodes, path, "node")


ACTIONS = ("create", "modify", "delete")


def write_change_xml(changes: DataFrame, path: str, kind: str) -> None:
    """Changes (an entity's columns and ``action``) as change XML, a folder for each action."""
    for action in ACTIONS:
        mine = changes.where(F.col("action") == action)
        mine.select(F.struct(*_xml_rows(mine, kind)).alias(kind)).write.format("xml").option("rootTag", "changes").option("rowTag", action).save(f"{path}/{action}")


def read_change_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Changes of one kind from change XML: the entity's columns and ``action``."""
    out = None
    for action in ACTIONS:
        raw = spark.read.format("xml").schema(T.StructType([T.StructField(kind, T.StructType([*ENVELOPE, *OWN[kind]]))])).option("rowTag", action).load(f"{path}/{action}")
        mine = _entities(raw.where(F.col(kind).isNotNull()).select(f"{kind}.*"), kind).withColumn("action", F.lit(action))
        out = mine if out is None else out.unionByName(mine)
    return out


def read_copy(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated bulk-load files, \\N for null."""
    return spark.read.schema(schema).option("sep", "\t").option("nullValue", "\\N").option("quote", "").csv(path)


def write_copy(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("nullValue", "\\N").option("quote", "").csv(path)


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """Tile list lines such as 63240001: 2400256,10240 to 2500608,120832 (# comments)."""
    pattern = r"^\s*(\d+):\s*(-?\d+),\s*(-?\d+)\s+to\s+(-?\d+),\s*(-?\d+)"
    rows = spark.read.text(path).where(F.col("value").rlike(pattern))
    part = lambda i: F.regexp_extract("value", pattern, i).cast("long")
    return rows.select(part(1).alias("tile_id"), part(2).alias("bottom"), part(3).alias("left"), part(4).alias("top"), part(5).alias("right"))


def write_areas(areas: DataFrame, path: str) -> None:
    areas.select(F.format_string("%d: %d,%d to %d,%d", "tile_id", "bottom", "left", "top", "right").alias("value")).write.text(path)


def read_problem_list(spark: SparkSession, path: str) -> DataFrame:
    """(kind, id) of lines way:<id> and rel:<id>, comments behind #."""
    pattern = r"^\s*(way|rel):\s*(\d+)"
    rows = spark.read.text(path).where(F.col("value").rlike(pattern))
    return rows.select(F.regexp_extract("value", pattern, 1).alias("kind"), F.regexp_extract("value", pattern, 2).cast("long").alias("id"))


def parse_symbols(text: str) -> list[tuple[str, int, int, str, str]]:
    """(kind, type, subtype, code, text) of symbol objects: [_point] ... [end] blocks with String lines."""
    out, kind, found, strings = [], None, {}, []
    for row in text.splitlines():
        row = row.split(";")[0].strip()
        if m := re.fullmatch(r"\[_(point|line|polygon)\]", row, re.I):
            kind, found, strings = m[1].lower(), {}, []
        elif row.lower() == "[end]":
            out += [(kind, found.get("type", 0), found.get("subtype", 0), c, t) for c, t in strings] if kind else []
            kind = None
        elif kind and (m := re.match(r"(?i)(type|subtype)\s*=\s*(0x[0-9a-f]+|\d+)", row)):
            found[m[1].lower()] = int(m[2], 0)
        elif kind and (m := re.match(r"(?i)string\d*\s*=\s*(0x[0-9a-f]+)\s*,\s*(.*)", row)):
            strings.append((m[1].lower(), m[2]))
    return out


def parse_translations(text: str) -> list[tuple[int, str, str | None, str]]:
    """(ord, key, lang or None, text) of lines #define $__KEY__LL text."""
    out = []
    for n, row in enumerate(text.splitlines()):
        if m := re.match(r"#define\s+\$__(\w+?)__([A-Z]{2})?\s+(.*)", row):
            out.append((n, m[1], m[2], m[3]))
    return out


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, url: str, name: str, options: dict[str, str], partition: Sequence = ()) -> DataFrame:
    """A database table; (column, low, high, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if partition:
        column, low, high, parts = partition
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load()


def write_tiles(df: DataFrame, path: str) -> None:
    """One folder a tile, rows clustered by tile before the write."""
    df.repartition("tile_id").sortWithinPartitions("tile_id").write.partitionBy("tile_id").parquet(path)
