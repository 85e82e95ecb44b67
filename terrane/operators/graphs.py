"""Relations and routing: member rewriting, recursion, edges, connected parts, nearby points, search index."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.plans import compile as plans
from terrane.plans.rules import RuleSet
from terrane.session import checkpointed

#: Rounds after which a fixpoint cuts its lineage.
CHECKPOINT_EVERY = 4
#: A key is hot if it holds more than one in HOT of a join's rows, and at least HOT_ROWS; so fewer than HOT keys are.
HOT, HOT_ROWS = 1024, 1000


def apply_to_members(relations: DataFrame, members: DataFrame, entities: DataFrame, rules: RuleSet) -> DataFrame:
    """entity id and the tag writes (id, key, value, ord) that ``apply`` actions of matching relations give its members.

    ${k} is the relation's tag and $(k) the member's own. Relations: id, tags; members: relation,
    member, role; entities: id, tags.
    """
    out = None
    joined = relations.select(F.col("id").alias("relation"), F.col("tags").alias("r_tags")).join(members, "relation")
    joined = joined.join(entities.select(F.col("id").alias("member"), F.col("tags").alias("m_tags")), "member")
    tag = lambda k: F.element_at("r_tags", F.lit(k))
    for rule in rules.rules:
        hit = plans.predicate(rule.predicate, tag, lambda n: F.lit(None))
        for apply in (a for a in rule.actions if a.kind == "apply"):
            mine = joined.where(hit if apply.role is None else hit & F.col("role").eqNullSafe(apply.role))
            for n, a in enumerate(apply.actions):
                alternatives = []
                for v in a.values:
                    parts = [F.lit(x) if isinstance(x, str) else plans.apply_filters(F.element_at("m_tags" if x.member else "r_tags", F.lit(x.key)), x.filters, tag) for x in v.parts]
                    alternatives.append(F.concat(*parts))
                value = F.coalesce(*alternatives) if alternatives else F.lit(None).cast("string")
                rows = mine.select(F.col("member").alias("id"), F.lit(a.kind).alias("kind"), F.lit(a.key).alias("key"), value.alias("value"), F.lit(rule.ord * 1000 + n).alias("ord"), "relation")
                rows = rows.where("value is not null or kind = 'delete'")
                out = rows if out is None else out.unionByName(rows)
    return out


def write_tags(entities: DataFrame, writes: DataFrame) -> DataFrame:
    """Entities after the writes in order: set takes the last, add only fills what is missing."""
    order = F.struct("ord", "relation")
    last = writes.where("kind = 'set'").groupBy("id", "key").agg(F.max_by("value", order).alias("value"))
    first = writes.where("kind = 'add'").groupBy("id", "key").agg(F.min_by("value", order).alias("value"))
    sets = last.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("sets"))
    adds = first.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("adds"))
    none = F.create_map().cast("map<string,string>")
    both = entities.join(sets, "id", "left").join(adds, "id", "left").withColumns({"sets": F.coalesce("sets", none), "adds": F.coalesce("adds", none)})
    base = F.map_concat(F.map_filter("tags", lambda k, v: ~F.map_contains_key("sets", k)), "sets")
    both = both.withColumn("tags", base).withColumn("tags", F.map_concat("tags", F.map_filter("adds", lambda k, v: ~F.map_contains_key("tags", k))))
    return both.select(*entities.columns)


def descendants(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, member, depth): everything that a relation reaches through sub-relations; cycles end by themselves."""
    found = roots.select(F.col("id").alias("root"), F.col("id").alias("member"), F.lit(0).alias("depth"))
    edge, reached = found, found
    for depth in count(1):
        step = edge.select("root", F.col("member").alias("relation")).join(members.select("relation", "member"), "relation").select("root", "member").distinct()
        edge = checkpointed(step.join(reached.select("root", "member"), ["root", "member"], "left_anti").withColumn("depth", F.lit(depth)))
        if not edge.take(1):
            break
        reached = reached.unionByName(edge)
        if depth % CHECKPOINT_EVERY == 0:
            reached = checkpointed(reached)
    return reached.where("depth > 0")


def routing_edges(way_nodes: DataFrame) -> DataFrame:
    """(way_id, seq, a, b): each node of a way to the next."""
    order = Window.partitionBy("way_id").orderBy("seq")
    return way_nodes.withColumn("b", F.lead("node_id").over(order)).where("b is not null").select("way_id", "seq", F.col("node_id").alias("a"), "b")


def opposite_edges(edges: DataFrame, where: Column) -> DataFrame:
    return edges.unionByName(edges.where(where).select("way_id", "seq", F.col("b").alias("a"), F.col("a").alias("b")))


def _by_key(rows: DataFrame, labels: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` joined with ``labels``, one row a key. Keys that hold over 1/HOT of the rows, fewer than HOT, are sent to all executors."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    most = rows.count() // HOT
    hot = checkpointed(counts.where(F.col("__n") > F.lit(most)).select(key)) if most >= HOT_ROWS else None
    if hot is None or not hot.take(1):
        return rows.join(labels, key, how)
    sent = F.broadcast(hot.join(labels, key, how))  # fewer than HOT rows
    return rows.join(sent, key).unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(labels, key, how))


def islands(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, island): the smallest node of each connected part, by spreading the minimum and jumping to its own.

    Hubs and large parts are hot keys of these joins; their few labels go to all executors, the rest is shuffled.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = checkpointed(both)
    label = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("island")).withColumnRenamed("a", "node")
    last = None
    for _ in range(most_rounds):
        near = _by_key(both, label.withColumnRenamed("node", "b"), "b", "inner").groupBy("a").agg(F.min("island").alias("near"))
        label = checkpointed(label.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("island", "near").alias("island")))
        jump = label.select(F.col("node").alias("island"), F.col("island").alias("further"))
        label = checkpointed(_by_key(label, jump, "island", "left").select("node", F.coalesce("further", "island").alias("island")))
        mark = label.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(node, island))")).first()
        if mark == last:
            return label
        last = mark
    raise RuntimeError("the islands did not settle")


def drop_islands(edges: DataFrame, parts: DataFrame, weight: str, least: float) -> DataFrame:
    """Edges of the connected parts whose total weight is at least ``least``."""
    named = edges.join(parts.select(F.col("node").alias("a"), "island"), "a")
    big = named.groupBy("island").agg(F.sum(weight).alias("w")).where(F.col("w") >= least).select("island")
    return named.join(big, "island", "left_semi").select(*edges.columns)


def nearby_duplicates(points: DataFrame, kind: str, distance_e7: int) -> DataFrame:
    """Points without those that have a same-kind point of a smaller id within the distance in both coordinates.

    Points of one kind and grid cell are all within the distance, so only the first of a cell can stay.
    It alone meets the points of the eight cells around it, so a point is compared eight times at most.
    """
    cx, cy = F.floor(F.col("lon_e7") / distance_e7), F.floor(F.col("lat_e7") / distance_e7)
    placed = points.select("id", "lat_e7", "lon_e7", F.col(kind).alias("kind")).where("kind is not null").withColumn("cx", cx).withColumn("cy", cy)
    first = placed.groupBy("kind", "cx", "cy").agg(F.min_by(F.struct("id", "lat_e7", "lon_e7"), "id").alias("p")).select("kind", "cx", "cy", "p.*")
    around = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (-1, 0, 1) for y in (-1, 0, 1) if x or y]))
    spread = first.withColumn("step", around).select("kind", (F.col("cx") + F.col("step.x")).alias("cx"), (F.col("cy") + F.col("step.y")).alias("cy"), "id", "lat_e7", "lon_e7")
    other = placed.select("kind", "cx", "cy", F.col("id").alias("o"), F.col("lat_e7").alias("o_lat"), F.col("lon_e7").alias("o_lon"))
    close = spread.join(other, ["kind", "cx", "cy"]).where((F.col("o") < F.col("id")) & (F.abs(F.col("lat_e7") - F.col("o_lat")) <= distance_e7) & (F.abs(F.col("lon_e7") - F.col("o_lon")) <= distance_e7))
    kept = first.select("id").join(close.select("id"), "id", "left_anti").select("id").union(points.where(F.col(kind).isNull()).select("id"))
    return points.join(kept, "id", "left_semi")


def nearest_along(points: DataFrame, places: DataFrame, street: str, at: str, place: str, cells: int = 1024) -> DataFrame:
    """``points`` with the ``place`` of the same street that is nearest along it, ties to the smaller; without one a point goes.

    A street is cut into cells of equal length. Within a cell each point sees the places before and
    behind it in one ordered pass; the last and first place of other cells come from one row a cell.
    """
    ends = places.groupBy(street).agg(F.min(at).alias("lo"), F.max(at).alias("hi"))

    def celled(df: DataFrame) -> DataFrame:
        share = F.when(F.col("hi") > F.col("lo"), (F.col(at) - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
        return df.join(ends, street).withColumn("cell", F.floor(F.greatest(F.lit(-1.0), F.least(share, F.lit(1.0))) * cells).cast("int")).drop("lo", "hi")

    first = celled(places.groupBy(street, at).agg(F.min(place).alias(place)))  # one place of those at the same spot
    spot = F.struct(F.col(at).alias("at"), F.col(place).alias("place"))
    by_cell = Window.partitionBy(street).orderBy("cell")
    edges = first.groupBy(street, "cell").agg(F.max_by(spot, at).alias("last"), F.min_by(spot, at).alias("first"))
    all_cells = edges.select(street, "cell", "last", "first").unionByName(celled(points).select(street, "cell").distinct().join(edges.select(street, "cell"), [street, "cell"], "left_anti").withColumns({"last": F.lit(None).cast(edges.schema["last"].dataType), "first": F.lit(None).cast(edges.schema["first"].dataType)}))
    carried = all_cells.select(street, "cell", F.last("last", ignorenulls=True).over(by_cell.rowsBetween(Window.unboundedPreceding, -1)).alias("left"), F.first("first", ignorenulls=True).over(by_cell.rowsBetween(1, Window.unboundedFollowing)).alias("right"))
    row = F.struct(*points.columns)
    both = celled(points).select(street, "cell", at, row.alias("row"), F.lit(None).cast(edges.schema["last"].dataType).alias("spot"))
    both = both.unionByName(first.select(street, "cell", at, F.lit(None).cast(both.schema["row"].dataType).alias("row"), spot.alias("spot")))
    order = Window.partitionBy(street, "cell").orderBy(at)
    seen = both.withColumns({"before": F.last("spot", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)), "behind": F.first("spot", ignorenulls=True).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))})
    seen = seen.where("row is not null").join(carried, [street, "cell"])
    found = F.array_compact(F.array("before", "behind", "left", "right"))
    best = F.array_min(F.transform(found, lambda x: F.struct(F.abs(F.col(at) - x["at"]).alias("d"), x["place"].alias("place"))))
    return seen.select("row.*", best["place"].alias(place))


def name_index(df: DataFrame, name: str, id_col: str) -> DataFrame:
    """(word, id): every word of a name, lower-cased."""
    words = F.explode(F.array_distinct(F.filter(F.split(F.lower(name), r"[\s\-/]+"), lambda w: w != "")))
    return df.select(words.alias("word"), id_col)


def link_points_to_ways(way_nodes: DataFrame, points: DataFrame, value: str) -> DataFrame:
    """(way_id, value): what point entities such as barriers say about the ways through them."""
    return way_nodes.join(points.select(F.col("id").alias("node_id"), value), "node_id").groupBy("way_id").agg(F.min(value).alias(value))


def area_points(lines: DataFrame) -> DataFrame:
    """A point at the middle of each polygon's box."""
    box = lambda f, c: f(F.transform("points", lambda p: p[c]))
    return lines.select("way_id", ((box(F.array_min, "lon_e7") + box(F.array_max, "lon_e7")) / 2).cast("long").alias("lon_e7"), ((box(F.array_min, "lat_e7") + box(F.array_max, "lat_e7")) / 2).cast("long").alias("lat_e7"))
