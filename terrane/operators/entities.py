"""Entity dataflow: filters, reference closure, reports, snapshots and changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.operators import regions
from terrane.session import checkpointed

TYPE_RANK = {"bound": 0, "node": 1, "way": 2, "relation": 3}


def tag_filter(df: DataFrame, keys: Sequence[str] = (), pairs: Sequence[tuple[str, str]] = (), tags: str = "tags", negate: bool = False) -> DataFrame:
    """Entities that have one of the keys, or one of the (key, value) pairs; ``negate`` keeps the others."""
    hit = F.lit(False)
    for k in keys:
        hit = hit | F.coalesce(F.map_contains_key(tags, k), F.lit(False))
    for k, v in pairs:
        hit = hit | F.coalesce(F.element_at(tags, F.lit(k)) == v, F.lit(False))
    return df.where(~hit if negate else hit)


def remove_tags(df: DataFrame, keys: Sequence[str] = (), prefixes: Sequence[str] = (), tags: str = "tags") -> DataFrame:
    def stays(k, _):
        gone = k.isin(list(keys)) if keys else F.lit(False)
        for p in prefixes:
            gone = gone | k.startswith(p)
        return ~gone

    return df.withColumn(tags, F.map_filter(tags, stays))


def tag_sort(df: DataFrame, tags: str = "tags") -> DataFrame:
    return df.withColumn(tags, F.map_from_entries(F.array_sort(F.map_entries(tags))))


def used(entities: DataFrame, *references: DataFrame, id_col: str = "id") -> DataFrame:
    """Entities that any of the one-column reference tables names."""
    refs = references[0].toDF(id_col)
    for r in references[1:]:
        refs = refs.union(r.toDF(id_col))
    return entities.join(refs, id_col, "left_semi")


def bbox_clip(nodes: DataFrame, left: int, bottom: int, right: int, top: int, lat: str = "lat_e7", lon: str = "lon_e7") -> DataFrame:
    """Nodes inside a box, edges included; plain comparisons, so that a scan prunes by them."""
    return nodes.where(F.col(lon).between(left, right) & F.col(lat).between(bottom, top))


def clip_ways(ways: DataFrame, way_nodes: DataFrame, nodes: DataFrame, complete: bool = False) -> tuple[DataFrame, DataFrame]:
    """Ways with a node inside, and their node references: all of them (complete) or only those inside."""
    inside = way_nodes.join(nodes.select(F.col("id").alias("node_id")), "node_id", "left_semi")
    kept = ways.join(inside.select(F.col("way_id").alias("id")), "id", "left_semi")
    refs = way_nodes.join(kept.select(F.col("id").alias("way_id")), "way_id", "left_semi") if complete else inside
    return kept, refs


def clip_relations(members: DataFrame, kept: DataFrame, cascading: bool = False) -> DataFrame:
    """(relation): those with a member among ``kept`` (member_type, member); ``cascading``: and all that hold one of them, to the end."""
    found = edge = checkpointed(members.join(kept, ["member_type", "member"], "left_semi").select("relation").distinct())
    while cascading:
        parents = members.where("member_type = 'R'").join(edge.select(F.col("relation").alias("member")), "member", "left_semi").select("relation").distinct()
        edge = checkpointed(parents.join(found, "relation", "left_anti"))
        if not edge.take(1):
            break
        found = checkpointed(found.union(edge))
    return found


def complete_relations(members: DataFrame, relations: DataFrame) -> DataFrame:
    """(member_type, member): all that the relations hold, through relations inside them to the end; cycles end by themselves."""
    edge, found = relations.select("relation"), None
    while True:
        held = members.join(edge, "relation", "left_semi").select("member_type", "member").distinct()
        fresh = checkpointed(held if found is None else held.join(found, ["member_type", "member"], "left_anti"))
        if found is not None and not fresh.take(1):
            return found
        found = fresh if found is None else checkpointed(found.union(fresh))
        edge = fresh.where("member_type = 'R'").select(F.col("member").alias("relation"))


def clip_incomplete(members: DataFrame, kept: DataFrame) -> DataFrame:
    """References without those to entities that are not among ``kept`` (member_type, member)."""
    return members.join(kept, ["member_type", "member"], "left_semi").select(*members.columns)


def polygon_clip(nodes: DataFrame, rings: Sequence[Sequence[tuple[int, int]]], lat: str = "lat_e7", lon: str = "lon_e7") -> DataFrame:
    """Nodes inside a polygon of any number of vertices, even-odd over its rings: its box first, which scans prune by, then its cells."""
    xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
    if not xs:
        return nodes.where(F.lit(False))
    near = bbox_clip(nodes, min(xs), min(ys), max(xs), max(ys), lat, lon)
    return regions.locate(near, regions.ring_table(nodes.sparkSession, rings), lat=lat, lon=lon).select(*[F.col(f"`{c}`") for c in nodes.columns])


def integrity_report(references: DataFrame, targets: DataFrame, by: Sequence[str], ref: str, id_col: str = "id") -> DataFrame:
    """References (by, ref) whose target is missing."""
    return references.join(targets.select(F.col(id_col).alias(ref)), ref, "left_anti").select(*by, ref)


def user_report(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Entities by user, and all of them under a null user."""
    return df.rollup(user).agg(F.count(F.lit(1)).alias("n"))


def bound(nodes: DataFrame, lat: str = "lat_e7", lon: str = "lon_e7") -> DataFrame:
    return nodes.agg(F.min(lon).alias("left"), F.min(lat).alias("bottom"), F.max(lon).alias("right"), F.max(lat).alias("top"))


def merge_bounds(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.unionByName(b)
    return both.agg(F.min("left").alias("left"), F.min("bottom").alias("bottom"), F.max("right").alias("right"), F.max("top").alias("top"))


def sort_entities(df: DataFrame, type_col: str = "type", id_col: str = "id", version: str = "version") -> DataFrame:
    rank = F.create_map(*[F.lit(x) for kv in TYPE_RANK.items() for x in kv])
    return df.orderBy(F.element_at(rank, F.col(type_col)), id_col, version)


def check_sorted(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that break the order of the partition they are in: a merge of sorted inputs needs none."""
    from pyspark.sql import types as T

    where = Window.partitionBy("part").orderBy("at")
    rows = df.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    key = F.struct(*columns)
    assert isinstance(df.schema, T.StructType)
    return rows.withColumn("before", F.lag(key).over(where)).where(F.col("before") > key).drop("part", "at", "before")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order; ranks are limited before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank_in_key", rank).where("rank_in_key = 1").drop("rank_in_key")


def merge(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("id",), version: str = "version", ts: str = "ts") -> DataFrame:
    """Both inputs; of one key the highest version stays, then the latest time."""
    return latest(a.unionByName(b), keys, [F.desc(version), F.desc(ts)])


def append_change(*changes: DataFrame) -> DataFrame:
    out = changes[0]
    for c in changes[1:]:
        out = out.unionByName(c)
    return out


def simplify_change(changes: DataFrame, keys: Sequence[str] = ("id",), version: str = "version", ts: str = "ts") -> DataFrame:
    """The last change of each entity."""
    return latest(changes, keys, [F.desc(version), F.desc(ts)])


def flatten(history: DataFrame, keys: Sequence[str] = ("id",), version: str = "version") -> DataFrame:
    """The latest version of each entity; of equal versions the one whose other values are the largest, so that the choice is always the same."""
    rest = [c for c, kind in history.dtypes if c not in (*keys, version) and not kind.startswith("map")]
    return latest(history, keys, [F.desc(version), F.desc(F.struct(*rest))] if rest else [F.desc(version)])


def derive_change(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """keys, action and the new values that turn ``old`` into ``new``."""
    rest = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*rest).alias("was"), F.lit(True).alias("in_old"))
    b = new.select(*keys, F.struct(*rest).alias("now"), F.lit(True).alias("in_new"))
    both = a.join(b, list(keys), "full")
    action = F.when(F.col("in_old").isNull(), "create").when(F.col("in_new").isNull(), "delete").when(~F.col("was").eqNullSafe(F.col("now")), "modify")
    return both.withColumn("action", action).where("action is not null").select(*keys, "action", *[F.col(f"now.{c}").alias(c) for c in rest])


def apply_change(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """The snapshot after the changes; a create of what exists replaces it. A change set must be simplified first."""
    if changes.groupBy(*keys).count().where("count > 1").take(1):
        raise ValueError("the changes hold more than one change of an entity; simplify them first")
    untouched = snapshot.join(changes.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(changes.where("action <> 'delete'").select(*snapshot.columns))


def to_history(changes: DataFrame) -> DataFrame:
    """Changes as versions with a visibility flag."""
    return changes.withColumn("visible", F.col("action") != "delete").drop("action")


def in_interval(df: DataFrame, begin, end, ts: str = "ts") -> DataFrame:
    """Changes in (begin, end]; a snapshot up to ``end`` includes equality."""
    return df.where((F.col(ts) > F.lit(begin)) & (F.col(ts) <= F.lit(end)))


def contained(points: DataFrame, areas: DataFrame, id_col: str, area_col: str, cell_e7: int | None = None, ring: str = "ring") -> DataFrame:
    """(id_col, area_col): the areas that each point (lon_e7, lat_e7) is in; an area has a ring of (x, y), however large.

    Cells follow each area's size and detail, so a point meets the areas whose border or inside is in its cell, and a few edges of these. ``cell_e7``: the largest cell.
    """
    own = areas.select(F.col(area_col).alias("area"), F.array(F.transform(ring, lambda p: F.struct(p["x"].cast("long").alias("x"), p["y"].cast("long").alias("y")))).alias("rings"))
    found = regions.locate(points.select(id_col, "lon_e7", "lat_e7"), own, side=cell_e7)
    return found.select(id_col, F.col("__area").alias(area_col))
