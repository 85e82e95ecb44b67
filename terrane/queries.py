"""All queries of the entity engine, by name, with the SQL that checks them.

Results hold scalar columns only: arrays are joined, times are whole numbers or timestamps, and
doubles are rounded, so that two engines can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane import views
from terrane.functions import maths, strings, texts, words
from terrane.operators import composites, cutting, entities, folds, geometry, graphs, partition, regions, roundabouts, sea, translate
from terrane.plans import compile as plans
from terrane.plans import rulesets
from terrane.plans.rules import parse_rules
from terrane.session import shared_folder, shuffled
from terrane.sources import pbf
from terrane.streaming import replicate, transactions
from terrane.views import table, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


FEATURE = ("id", "ord", "type", "low", "high", "label")


def features(spark, sf_dir, rules: str, *more) -> DataFrame:
    return plans.apply_rules(views.nodes(spark, sf_dir), parse_rules(rules)).select(*FEATURE, *more)


# Rules -------------------------------------------------------------------------

FIRST_MATCH = """
ptype = PROMO & size > 25 { name '${pname} (${size})' | '${pname}' } [0x4803 resolution 23]
ptype = PROMO { name '${pname}' } [0x4804 resolution 20-22]
ptype = ECONOMY | ptype = SMALL { name '${nick}' | '${brand}' } [0x2f01]
size < 10 [0x0100 resolution 12 default_name 'tiny']
ptype = * [0x0200 resolution 14]
"""


@query("""SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' AND p_size > 25 THEN 0 WHEN p_type = 'PROMO' THEN 1 WHEN p_type IN ('ECONOMY', 'SMALL') THEN 2 WHEN p_size < 10 THEN 3 ELSE 4 END AS ord,
  CASE ord WHEN 0 THEN 18435 WHEN 1 THEN 18436 WHEN 2 THEN 12033 WHEN 3 THEN 256 ELSE 512 END AS type, CASE ord WHEN 0 THEN 23 WHEN 1 THEN 20 WHEN 2 THEN 24 WHEN 3 THEN 12 ELSE 14 END AS low,
  CASE ord WHEN 1 THEN 22 ELSE 24 END AS high, CASE ord WHEN 0 THEN p_name || ' (' || p_size || ')' WHEN 1 THEN p_name WHEN 2 THEN p_brand WHEN 3 THEN 'tiny' END AS label FROM part""")
def rule_first_match(spark, sf_dir):
    return features(spark, sf_dir, FIRST_MATCH)


@query("""SELECT id, ord, type FROM (SELECT p_partkey AS id, p_type AS t, p_size AS s FROM part) JOIN (VALUES (0, 1), (1, 2), (2, 3), (3, 4), (4, 5)) AS f(ord, type)
  ON (ord = 0 AND t = 'LARGE') OR (ord = 1 AND t = 'LARGE' AND s > 30) OR (ord = 2 AND t <> 'LARGE' AND s > 30) OR ord = 3""")
def rule_continue_fork(spark, sf_dir):
    rules = "ptype = LARGE { set routed = yes } [0x01 road_class=4 road_speed=7 continue with_actions]\nrouted = yes & size > 30 [0x02 continue]\nrouted != yes & size > 30 [0x03 continue]\nptype = * { set tmp = 1 } [0x04 continue]\ntmp = 1 [0x05]"
    return features(spark, sf_dir, rules).select("id", "ord", "type")


@query("""SELECT p_partkey AS id, CASE WHEN p_size > 40 THEN 'big' ELSE p_brand END AS brand, coalesce(CASE WHEN p_type = 'PROMO' THEN 'promo' END, 'plain') AS flag, CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_name END AS pname,
  p_type || '/' || p_brand AS joined FROM part""")
def rule_set_add_delete(spark, sf_dir):
    rules = "ptype = * { set joined = '${ptype}/${brand}' }\nsize > 40 { set brand = big; add brand = never }\nptype = PROMO { set flag = promo }\nptype = * { add flag = plain }\nptype = SMALL { delete pname }\nptype = * [0x1]"
    return features(spark, sf_dir, rules, *[F.element_at("tags", F.lit(k)).alias(k) for k in ("brand", "flag", "pname", "joined")]).select("id", "brand", "flag", "pname", "joined")


@query("SELECT p_partkey AS id, p_type IS DISTINCT FROM 'PROMO' AS not_promo, true AS not_missing FROM part")
def rule_neq_absent(spark, sf_dir):
    rules = parse_rules("ptype != PROMO { set a = 1 }\nnowhere != x { set b = 1 }\nptype = * [0x1]")
    got = plans.apply_rules(views.nodes(spark, sf_dir), rules)
    return got.select("id", F.map_contains_key("tags", "a").alias("not_promo"), F.map_contains_key("tags", "b").alias("not_missing"))


@query("SELECT p_partkey AS id, regexp_full_match(p_name, '(?:small|large) .*t') AS whole, regexp_full_match(p_brand, 'Brand#1[0-9]') AS brand FROM part")
def rule_regex_full(spark, sf_dir):
    rules = parse_rules("pname ~ '(?:small|large) .*t' { set a = 1 }\nbrand ~ 'Brand#1[0-9]' { set b = 1 }\npname ~ 'widget' { set a = wrong }\nptype = * [0x1]")
    got = plans.apply_rules(views.nodes(spark, sf_dir), rules)
    return got.select("id", F.map_contains_key("tags", "a").alias("whole"), F.map_contains_key("tags", "b").alias("brand"))


@query("SELECT p_partkey AS id, CASE WHEN p_size > 40 THEN 'xl' WHEN p_size >= 20 THEN 'l' WHEN p_size <= 5 THEN 's' ELSE 'm' END AS class FROM part")
def rule_numeric_cmp(spark, sf_dir):
    rules = parse_rules("size > 40 { set c = xl }\nsize >= 20 { add c = l }\nsize <= 5 { add c = s }\nptype = * { add c = m } [0x1]")
    return plans.apply_rules(views.nodes(spark, sf_dir), rules).select("id", F.element_at("tags", F.lit("c")).alias("class"))


@query("SELECT p_partkey AS id, p_type = p_brand AS same, true AS copied FROM part")
def rule_tag_eq_tag(spark, sf_dir):
    rules = parse_rules("ptype = ${brand} { set a = 1 }\nptype = * { set copy = '${brand}' }\ncopy = ${brand} { set b = 1 }\nptype = * [0x1]")
    got = plans.apply_rules(views.nodes(spark, sf_dir), rules)
    return got.select("id", F.map_contains_key("tags", "a").alias("same"), F.map_contains_key("tags", "b").alias("copied"))


@query("SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3 END AS type FROM part WHERE p_type IN ('PROMO', 'MEDIUM', 'LARGE')")
def rule_table_join(spark, sf_dir):
    rules = parse_rules("ptype = PROMO [0x1]\nptype = MEDIUM [0x2]\nptype = PROMO [0x9]\nptype = LARGE [0x3]")
    return plans.classify_by_join(views.nodes(spark, sf_dir), rules, "ptype", F.element_at("tags", F.lit("ptype"))).select("id", "type")


@query("SELECT p_partkey AS id, ord, type FROM part JOIN (VALUES (0, 1), (1, 2)) f(ord, type) ON (ord = 0 AND p_size > 25) OR (ord = 1 AND p_type = 'PROMO')")
def rule_interpreter(spark, sf_dir):
    rules = parse_rules("size > 25 [0x1 continue]\nptype = PROMO [0x2]")
    return plans.apply_rules(views.nodes(spark, sf_dir), rules, strategy="interpreter").select("id", "ord", "type")


@query("SELECT p_partkey AS id, CASE WHEN p_size > 30 THEN p_name WHEN p_type = 'PROMO' THEN p_brand ELSE 'nameless' END AS label FROM part")
def label_fallback(spark, sf_dir):
    rules = "size > 30 { set alt = '${pname}' }\nptype = PROMO { add alt = '${brand}' }\nptype = * { name '${nick}' | '${alt}' } [0x1 default_name 'nameless']"
    return features(spark, sf_dir, rules).select("id", "label")


@query("SELECT p_partkey AS id, replace(replace(p_name, 'small ', ''), 'widget', 'gadget') AS v FROM part")
def filter_subst(spark, sf_dir):
    rules = "ptype = * { set v = '${pname|subst:\"small \"|subst:widget=>gadget}' } [0x1]"
    return features(spark, sf_dir, rules, F.element_at("tags", F.lit("v")).alias("v")).select("id", "v")


@query("SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS first, coalesce(nullif(split_part(p_name, ' ', 3), ''), 'none') AS third FROM part")
def filter_part(spark, sf_dir):
    rules = "ptype = * { set a = '${pname|part: :1}'; set b = '${pname|part: :3}' | 'none' } [0x1]"
    tag = lambda k: F.element_at("tags", F.lit(k))
    return features(spark, sf_dir, rules, tag("a").alias("first"), tag("b").alias("third")).select("id", "first", "third")


@query("SELECT p_partkey AS id, round(p_size * 3.28084)::BIGINT::VARCHAR || ' ft' AS v FROM part")
def filter_conv(spark, sf_dir):
    rules = "size = * { name '${size|conv:m=>ft} ft' } [0x1]"
    return features(spark, sf_dir, rules).select("id", F.col("label").alias("v"))


@query("SELECT p_partkey AS id, 'no nick of ' || p_brand AS v FROM part")
def filter_default(spark, sf_dir):
    return features(spark, sf_dir, "ptype = * { name '${nick|def:no nick} of ${brand}' } [0x1]").select("id", F.col("label").alias("v"))


@query("SELECT p_partkey AS id, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN 'listed' ELSE p_type END AS v FROM part")
def filter_not_contained(spark, sf_dir):
    rules = "ptype = * { set list = 'PROMO;SMALL;LARGE'; name '${ptype|not-contained:;:list}' | 'listed' } [0x1]"
    return features(spark, sf_dir, rules).select("id", F.col("label").alias("v"))


LEVELS = tuple((i, 24 - i) for i in range(8))
OVERVIEW = ((8, 16), (9, 14), (10, 12), (11, 11))
RANGED = "ptype = PROMO [0x1 resolution 20-22]\nsize > 25 [0x2 resolution 18]\nptype = * [0x3 resolution 12]"


@query("SELECT p_partkey AS id, type, 24 - r AS level, r AS resolution FROM (SELECT *, CASE WHEN p_type = 'PROMO' THEN 1 WHEN p_size > 25 THEN 2 ELSE 3 END AS type FROM part), range(17, 25) t(r) WHERE (type = 1 AND r BETWEEN 20 AND 22) OR (type = 2 AND r >= 18) OR type = 3")
def level_explode(spark, sf_dir):
    return composites.explode_levels(features(spark, sf_dir, RANGED), LEVELS).select("id", "type", "level", "resolution")


@query("SELECT p_partkey AS id, level, resolution FROM part, (VALUES (8, 16), (9, 14), (10, 12), (11, 11)) o(level, resolution) WHERE p_type <> 'PROMO' AND p_size <= 25 AND resolution >= 12")
def overview_levels(spark, sf_dir):
    return composites.explode_levels(features(spark, sf_dir, RANGED), OVERVIEW).select("id", "level", "resolution")


# Composites over orders -----------------------------------------------------------

def order_tags() -> dict:
    return {
        "access": F.when(F.col("o_orderstatus") == "F", "private").when(F.col("o_orderstatus") == "P", "permissive").when(F.col("o_orderkey") % 5 == 0, "delivery").when(F.col("o_orderkey") % 5 == 1, "residents").when(F.col("o_orderkey") % 5 == 2, "odd"),
        "vehicle": F.when(F.col("o_orderpriority") == "1-URGENT", "yes"),
        "motor_vehicle": F.when(F.col("o_orderpriority") == "5-LOW", "forestry"),
        "foot": F.when(F.col("o_custkey") % 3 == 0, "designated"),
        "maxspeed": F.when(F.col("o_orderkey") % 4 == 0, F.concat((F.col("o_orderkey") % 90 + 5).cast("string"), F.lit(" mph"))).when(F.col("o_orderkey") % 4 == 1, (F.col("o_orderkey") % 140).cast("string")).when(F.col("o_orderkey") % 4 == 2, "signals"),
        "highway": F.element_at(F.array(*map(F.lit, ("motorway_link", "trunk", "primary_link", "track", "link_road"))), (F.col("o_orderkey") % 5 + 1).cast("int")),
        "tracktype": F.when(F.col("o_orderkey") % 7 > 0, F.concat(F.lit("grade"), (F.col("o_orderkey") % 7).cast("string"))),
        "surface": F.when(F.col("o_orderkey") % 3 != 0, F.element_at(F.array(*map(F.lit, ("asphalt", "gravel", "sand", "paved"))), (F.col("o_orderkey") % 4 + 1).cast("int"))),
        "smoothness": F.when(F.col("o_orderkey") % 6 == 0, "very_bad").when(F.col("o_orderkey") % 6 == 1, "good"),
    }


ORDER_SQL = """WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'private' WHEN o_orderstatus = 'P' THEN 'permissive' ELSE ['delivery', 'residents', 'odd', NULL, NULL][o_orderkey % 5 + 1] END AS access, CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' END AS vehicle,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'forestry' END AS motor_vehicle, CASE WHEN o_custkey % 3 = 0 THEN 'designated' END AS foot,
  CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 90 + 5) || ' mph' WHEN 1 THEN (o_orderkey % 140)::VARCHAR WHEN 2 THEN 'signals' END AS maxspeed,
  ['motorway_link', 'trunk', 'primary_link', 'track', 'link_road'][o_orderkey % 5 + 1] AS highway, CASE WHEN o_orderkey % 7 > 0 THEN 'grade' || (o_orderkey % 7) END AS tracktype,
  CASE WHEN o_orderkey % 3 <> 0 THEN ['asphalt', 'gravel', 'sand', 'paved'][o_orderkey % 4 + 1] END AS surface, CASE o_orderkey % 6 WHEN 0 THEN 'very_bad' WHEN 1 THEN 'good' END AS smoothness FROM orders)
"""


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), *[c.alias(k) for k, c in order_tags().items()])


#: What the rules say of a value: yes, no, or nothing.
SAYS_SQL = "CASE WHEN {0} IN ('yes', 'designated', 'permissive', 'destination', 'customers', 'official', 'public', 'residents', 'customer', 'residential') THEN 'yes' WHEN {0} IN ('no', 'military', 'private', 'agricultural', 'forestry', 'delivery', 'restricted', 'psv', 'bus', 'unknown') THEN 'no' END"


@query(ORDER_SQL + f""", n AS (SELECT id, foot AS foot_tag, access AS access_tag, vehicle AS vehicle_tag, motor_vehicle AS motor_tag, {", ".join(SAYS_SQL.format(k) + " AS " + k for k in ("access", "vehicle", "motor_vehicle", "foot"))} FROM o),
m AS (SELECT id,
  CASE WHEN motor_vehicle IS NOT NULL THEN motor_vehicle WHEN vehicle IS NOT NULL THEN vehicle WHEN access IS NOT NULL THEN access WHEN motor_tag IS NULL AND vehicle_tag IS NULL AND access_tag IS NULL THEN 'yes' ELSE 'no' END AS car,
  CASE WHEN vehicle IS NOT NULL THEN vehicle WHEN access IS NOT NULL THEN access WHEN vehicle_tag IS NULL AND access_tag IS NULL AND foot_tag IS DISTINCT FROM 'designated' THEN 'yes' ELSE 'no' END AS bicycle,
  CASE WHEN foot IS NOT NULL THEN foot WHEN access IS NOT NULL THEN access WHEN foot_tag IS NULL AND access_tag IS NULL THEN 'yes' ELSE 'no' END AS foot FROM n)
SELECT *, car = 'yes' OR bicycle = 'yes' OR foot = 'yes' AS routable FROM m""")
def access_inherit(spark, sf_dir):
    col = F.col
    inherit = composites.inherit_access
    modes = {"car": inherit(col("motor_vehicle"), col("vehicle"), col("access")), "bicycle": inherit(col("vehicle"), col("access"), reserved=col("foot").isin("designated", "official")), "foot": inherit(col("foot"), col("access"))}
    o = orders(spark, sf_dir).select("id", *[c.alias(k) for k, c in modes.items()])
    return o.withColumn("routable", composites.routable(col("car"), col("bicycle"), col("foot")))


#: One step for each mode: (mode, what it says where nothing is set, whether it becomes a plain yes).
OFFICIAL_STEPS = (
    ("foot", "bicycle no, vehicle no, motor_vehicle no, motorcar no, access no", True), ("bicycle", "foot no, vehicle no, motor_vehicle no, motorcar no, access no", True),
    ("vehicle", "bicycle yes, foot no, motor_vehicle yes, motorcar yes, access no", False), ("motor_vehicle", "bicycle no, vehicle no, foot no, motorcar yes, access no", False),
    ("motorcar", "bicycle no, vehicle no, motor_vehicle no, foot no, access no", False), ("access", "foot yes, bicycle yes, vehicle yes, motor_vehicle yes", True),
)


def official_sql() -> str:
    """The steps one after the other, each a table."""
    modes, steps = [m for m, _, _ in OFFICIAL_STEPS], []
    for i, (mode, says, plain) in enumerate(OFFICIAL_STEPS):
        fills = dict(x.split() for x in says.split(", "))
        new = [f"CASE WHEN {mode} = 'official' AND {k} IS NULL THEN '{fills[k]}' ELSE {k} END AS {k}" if k in fills else f"CASE WHEN {k} = 'official' THEN 'yes' ELSE {k} END AS {k}" if plain and k == mode else k for k in modes]
        signed = f"CASE WHEN {mode} = 'official' THEN 'yes' ELSE bfdesignated END AS bfdesignated" if i < 2 else "bfdesignated"
        steps.append(f"s{i + 1} AS (SELECT id, {', '.join(new)}, {signed} FROM s{i})")
    tags = ", ".join(f"CASE WHEN o_orderkey % {p} = 0 THEN 'official' WHEN o_orderkey % {p} = 1 THEN '{other}' END AS {k}" for k, p, other in OFFICIAL_DATA)
    start = f"t AS (SELECT o_orderkey AS id, {tags}, ['cycleway', 'footway', 'track'][o_custkey % 3 + 1] AS highway FROM orders), s0 AS (SELECT id, CASE WHEN foot IS NULL AND highway = 'footway' AND access IS NULL THEN 'yes' ELSE foot END AS foot, CASE WHEN bicycle IS NULL AND highway = 'cycleway' AND access IS NULL AND vehicle IS NULL THEN 'yes' ELSE bicycle END AS bicycle, vehicle, motor_vehicle, motorcar, access, NULL::VARCHAR AS bfdesignated FROM t)"
    last = "SELECT id, vehicle, motor_vehicle, motorcar, access, CASE WHEN foot = 'designated' OR bicycle = 'designated' THEN 'yes' ELSE bfdesignated END AS bfdesignated, CASE WHEN foot = 'designated' THEN 'yes' ELSE foot END AS foot, CASE WHEN bicycle = 'designated' THEN 'yes' ELSE bicycle END AS bicycle FROM s6"
    return f"WITH {start}, {', '.join(steps)} {last}"


OFFICIAL_DATA = (("foot", 3, "designated"), ("bicycle", 5, "designated"), ("vehicle", 7, "private"), ("motor_vehicle", 4, "destination"), ("motorcar", 6, "no"), ("access", 11, "private"))


@query(official_sql())
def access_official(spark, sf_dir):
    key = F.col("o_orderkey")
    tags = {k: F.when(key % p == 0, "official").when(key % p == 1, other) for k, p, other in OFFICIAL_DATA}
    highway = F.element_at(F.array(F.lit("cycleway"), F.lit("footway"), F.lit("track")), (F.col("o_custkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(key.alias("id"), *[c.alias(k) for k, c in composites.official_access(tags, highway).items()])


@query(ORDER_SQL + "SELECT id, coalesce(vehicle, access) AS vehicle, coalesce(motor_vehicle, vehicle, access) AS motor_vehicle, coalesce(motor_vehicle, vehicle, access) AS bus, coalesce(foot, motor_vehicle, vehicle, access) AS taxi FROM o")
def access_tree(spark, sf_dir):
    tree = composites.access_tree(F.col("access"), F.col("vehicle"), F.col("motor_vehicle"), {"bus": F.lit(None).cast("string"), "taxi": F.col("foot")})
    return orders(spark, sf_dir).select("id", *[c.alias(k) for k, c in tree.items()])


@query(ORDER_SQL + """, k AS (SELECT id, CASE WHEN maxspeed LIKE '% mph' THEN round(split_part(maxspeed, ' ', 1)::DOUBLE * 1.609344, 4) WHEN maxspeed <> 'signals' THEN maxspeed::DOUBLE END AS kmh FROM o)
SELECT id, kmh, CASE WHEN kmh > 110 THEN 7 WHEN kmh > 90 THEN 6 WHEN kmh > 80 THEN 5 WHEN kmh > 60 THEN 4 WHEN kmh > 40 THEN 3 WHEN kmh > 20 THEN 2 WHEN kmh > 10 THEN 1 WHEN kmh IS NOT NULL THEN 0 END AS class FROM k""")
def speed_class(spark, sf_dir):
    o = orders(spark, sf_dir).select("id", F.round(plans.as_speed(F.col("maxspeed")), 4).alias("kmh"))
    return o.withColumn("class", composites.speed_class(F.col("kmh")))


ROADS = ("motorway", "trunk_link", "primary", "secondary", "primary_link", "residential", "track")


@query(ORDER_SQL + """, k AS (SELECT id, ['motorway', 'trunk_link', 'primary', 'secondary', 'primary_link', 'residential', 'track'][id % 7 + 1] AS highway, CASE WHEN id % 11 = 0 THEN 'none' ELSE maxspeed END AS maxspeed FROM o),
s AS (SELECT *, CASE WHEN maxspeed LIKE '% mph' THEN split_part(maxspeed, ' ', 1)::DOUBLE * 1.609344 ELSE try_cast(maxspeed AS DOUBLE) END AS v FROM k)
SELECT id, highway, CASE
  WHEN (v > 120 OR maxspeed = 'none') AND highway = 'motorway' THEN 7
  WHEN v > 100 AND highway = 'motorway' THEN 6
  WHEN v > 80 AND highway IN ('motorway', 'trunk_link', 'primary') THEN 5
  WHEN v > 60 AND highway IN ('motorway', 'trunk_link', 'primary', 'secondary') THEN 4
  WHEN v > 40 AND highway IN ('motorway', 'trunk_link', 'primary', 'secondary', 'primary_link') THEN 3
  WHEN v > 30 AND highway <> 'track' THEN 2
  WHEN v > 10 AND highway <> 'track' THEN 1
  WHEN v > 80 THEN 4 WHEN v > 60 THEN 3 WHEN v > 40 THEN 2 WHEN v > 30 THEN 1 WHEN v < 11 THEN 0 END AS class FROM s""")
def highway_speed_class(spark, sf_dir):
    o = orders(spark, sf_dir).select("id", F.element_at(F.array(*map(F.lit, ROADS)), (F.col("id") % 7 + 1).cast("int")).alias("highway"), F.when(F.col("id") % 11 == 0, "none").otherwise(F.col("maxspeed")).alias("maxspeed"))
    return o.select("id", "highway", composites.highway_speed_class(plans.as_speed(F.col("maxspeed")), F.col("maxspeed"), F.col("highway")).alias("class"))


@query(ORDER_SQL + "SELECT id, CASE highway WHEN 'motorway_link' THEN 'motorway' WHEN 'primary_link' THEN 'primary' ELSE highway END AS highway FROM o")
def link_collapse(spark, sf_dir):
    return orders(spark, sf_dir).select("id", composites.collapse_link(F.col("highway")).alias("highway"))


@query(ORDER_SQL + "SELECT id, CASE tracktype WHEN 'grade1' THEN 'feldweg1' WHEN 'grade4' THEN 'feldweg45' WHEN 'grade5' THEN 'feldweg45' ELSE 'feldweg023' END AS class FROM o WHERE highway = 'track'")
def track_grade(spark, sf_dir):
    return orders(spark, sf_dir).where("highway = 'track'").select("id", composites.track_grade(F.col("tracktype")).alias("class"))


@query(ORDER_SQL + "SELECT id, coalesce(surface IN ('gravel', 'sand'), false) OR coalesce(tracktype IN ('grade2', 'grade3', 'grade4', 'grade5'), false) OR (highway = 'track' AND surface IS NULL AND tracktype IS NULL AND smoothness IS NULL) AS unpaved FROM o")
def unpaved_flag(spark, sf_dir):
    return orders(spark, sf_dir).select("id", composites.unpaved(*map(F.col, ("highway", "surface", "tracktype", "smoothness"))).alias("unpaved"))


SCALES = ("hiking", "mountain_hiking", "demanding_mountain_hiking", "alpine_hiking", "demanding_alpine_hiking", "difficult_alpine_hiking", "no")


@query("""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'footway' ELSE 'path' END AS highway, ['hiking', 'mountain_hiking', 'demanding_mountain_hiking', 'alpine_hiking', 'demanding_alpine_hiking', 'difficult_alpine_hiking', 'no'][p_size % 7 + 1] AS sac, CASE WHEN p_partkey % 5 > 0 THEN p_name END AS name, p_size % 7 + 1 AS t FROM part)
SELECT id, CASE WHEN highway <> 'path' OR t = 7 THEN highway WHEN t = 1 THEN 'sacscalet1' WHEN t <= 3 THEN 'sacscalet2t3' ELSE 'sacscalet4t5t6' END AS highway,
  CASE WHEN highway <> 'path' OR t = 7 THEN name ELSE coalesce(name, 'Alpine trail') || ' (T' || t || ')' END AS name, highway = 'path' AND t BETWEEN 4 AND 6 AS closed FROM p""")
def sac_scale(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 == 0, "footway").otherwise("path").alias("highway"), F.element_at(F.array(*map(F.lit, SCALES)), (F.col("p_size") % 7 + 1).cast("int")).alias("sac"), F.when(F.col("p_partkey") % 5 > 0, F.col("p_name")).alias("name"))
    return p.select("id", *[c.alias(k) for k, c in composites.hiking(F.col("highway"), F.col("sac"), F.col("name")).items()])


@query("""WITH p AS (SELECT p_partkey AS id, ['path', 'footway', 'cycleway', 'service'][p_partkey % 4 + 1] AS highway, p_size % 2 = 0 AS bike, p_size % 3 > 0 AS foot, p_size % 5 < 2 AS signed FROM part)
SELECT id, CASE WHEN highway = 'service' THEN 'service'
  WHEN bike AND foot AND (highway <> 'path' OR signed) THEN 'radfussweg'
  WHEN foot AND (highway = 'footway' OR highway = 'path' AND signed) THEN 'fussweg'
  WHEN highway = 'cycleway' OR highway = 'path' AND bike AND signed THEN 'radweg' ELSE highway END AS highway FROM p""")
def path_retype(spark, sf_dir):
    yes = lambda c: F.when(c, "yes").otherwise("no")
    size = F.col("p_size")
    highway = F.element_at(F.array(*map(F.lit, ("path", "footway", "cycleway", "service"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), composites.retype_paths(highway, yes(size % 2 == 0), yes(size % 3 > 0), size % 5 < 2).alias("highway"))


@query("""WITH a AS (SELECT c_custkey AS id, ['DEU', 'AUT', 'NLD', 'FRA'][c_custkey % 4 + 1] AS country, CASE WHEN c_custkey % 9 = 0 THEN 'Hamburg' ELSE c_mktsegment END AS l4, CASE WHEN c_custkey % 5 = 0 THEN 'X' END AS known,
  CASE WHEN c_custkey % 3 = 0 THEN 'Gemeinde ' || c_name WHEN c_custkey % 3 = 1 THEN 'Stadt ' || c_name END AS l8, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS l6, CASE WHEN c_custkey % 7 < 4 THEN 'Stadt 10' END AS l10, 'nine' AS l9 FROM customer)
SELECT id, country, CASE WHEN country = 'DEU' AND l4 = 'Hamburg' THEN 'Hamburg' WHEN known IS NOT NULL THEN known
  WHEN country = 'NLD' THEN coalesce(l10, l8) WHEN country = 'DEU' THEN coalesce(replace(replace(l8, 'Gemeinde ', ''), 'Stadt ', ''), l6, l9) WHEN country = 'AUT' THEN coalesce(replace(replace(l10, 'Gemeinde ', ''), 'Stadt ', ''), replace(l8, 'Gemeinde ', '')) END AS city FROM a""")
def city_special_cases(spark, sf_dir):
    key, name = F.col("c_custkey"), F.col("c_name")
    country = F.element_at(F.array(*map(F.lit, ("DEU", "AUT", "NLD", "FRA"))), (key % 4 + 1).cast("int"))
    levels = {4: F.when(key % 9 == 0, "Hamburg").otherwise(F.col("c_mktsegment")), 8: F.when(key % 3 == 0, F.concat(F.lit("Gemeinde "), name)).when(key % 3 == 1, F.concat(F.lit("Stadt "), name)), 6: F.when(key % 2 == 0, F.col("c_mktsegment")), 9: F.lit("nine"), 10: F.when(key % 7 < 4, "Stadt 10")}
    return table(spark, sf_dir, "customer").select(key.alias("id"), country.alias("country"), composites.city_of(country, levels, F.when(key % 5 == 0, "X")).alias("city"))


@query(ORDER_SQL + "SELECT id, CASE WHEN surface IN ('sand', 'gravel') THEN NULL ELSE surface END AS surface, CASE WHEN surface IN ('sand', 'gravel') THEN surface ELSE highway END AS highway FROM o")
def value_move(spark, sf_dir):
    tags = F.create_map(F.lit("surface"), F.col("surface"), F.lit("highway"), F.col("highway"))
    moved = composites.move_values(F.col("tags"), "surface", "highway", ("sand", "gravel"))
    got = orders(spark, sf_dir).select("id", tags.alias("tags")).select("id", moved.alias("tags"))
    return got.select("id", *[F.element_at("tags", F.lit(k)).alias(k) for k in ("surface", "highway")])


ADDRESS_PRIORITIES = [("EUROPE", "mktsegment", 0), ("EUROPE", "nation", 1), ("ASIA", "nation", 0), ("ASIA", "mktsegment", 1), ("AFRICA", "name", 0), ("AMERICA", "region", 0), ("AMERICA", "name", 1), ("MIDDLE EAST", "name", 5), ("MIDDLE EAST", "nation", 2)]


@query("""WITH p(region, level, priority) AS (VALUES ('EUROPE', 'mktsegment', 0), ('EUROPE', 'nation', 1), ('ASIA', 'nation', 0), ('ASIA', 'mktsegment', 1), ('AFRICA', 'name', 0), ('AMERICA', 'region', 0), ('AMERICA', 'name', 1), ('MIDDLE EAST', 'name', 5), ('MIDDLE EAST', 'nation', 2)),
a AS (SELECT c_custkey AS id, r_name AS region, n_name, c_name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS seg FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
l AS (SELECT id, region, 'mktsegment' AS level, seg AS value FROM a UNION ALL SELECT id, region, 'nation', n_name FROM a UNION ALL SELECT id, region, 'name', c_name FROM a UNION ALL SELECT id, region, 'region', region FROM a)
SELECT id, arg_min(value, priority) AS city FROM l JOIN p USING (region, level) WHERE value IS NOT NULL GROUP BY id""")
def address_priority(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    a = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    pairs = {"mktsegment": F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")), "nation": F.col("n_name"), "name": F.col("c_name"), "region": F.col("r_name")}
    long = a.select(F.col("c_custkey").alias("id"), F.col("r_name").alias("region"), F.explode(F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)])).alias("level", "value")).where("value is not null")
    priorities = spark.createDataFrame(ADDRESS_PRIORITIES, "region string, level string, priority int")
    return composites.by_priority(long, priorities, ["region", "level"], "id").withColumnRenamed("value", "city")


@query("""SELECT s_suppkey AS id, r_name AS country, CASE r_name WHEN 'EUROPE' THEN 'no' WHEN 'ASIA' THEN 'yes' ELSE 'unknown' END AS moped FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def country_override(spark, sf_dir):
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    defaults = spark.createDataFrame([("EUROPE", "no"), ("ASIA", "yes")], "country string, moped string")
    a = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("s_suppkey").alias("id"), F.col("r_name").alias("country"))
    return a.join(F.broadcast(defaults), "country", "left").select("id", "country", F.coalesce("moped", F.lit("unknown")).alias("moped"))  # a rule table


@query(r"""WITH t AS (SELECT doc_id, regexp_replace(text, '[\t\n\f\r ]+', ' ', 'g') AS name FROM documents),
p AS (SELECT doc_id, name, CASE WHEN starts_with(name, 'The ') THEN 'The' WHEN starts_with(name, 'La ') THEN 'La' WHEN starts_with(name, 'Der ') THEN 'Der' WHEN starts_with(name, 'A ') THEN 'A' WHEN name IS NOT NULL THEN '' END AS prefix FROM t),
c AS (SELECT doc_id, prefix, CASE WHEN prefix = '' THEN name ELSE substr(name, length(prefix) + 2) END AS rest FROM p),
s AS (SELECT *, CASE WHEN suffix(rest, ' of the.') THEN 'of the.' WHEN suffix(rest, ' the.') THEN 'the.' WHEN suffix(rest, ' to.') THEN 'to.' WHEN suffix(rest, ' reserved.') THEN 'reserved.' WHEN rest IS NOT NULL THEN '' END AS ending FROM c)
SELECT doc_id, prefix, CASE WHEN ending = '' THEN rest ELSE left(rest, length(rest) - length(ending) - 1) END AS core, ending AS suffix FROM s""")
def road_affix_split(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"[\t\n\f\r ]+", " ").alias("name"))
    prefix, core, suffix = composites.split_affix(F.col("name"), ("The", "La", "Der", "A"), ("of the.", "the.", "to.", "reserved."))
    return t.select("doc_id", prefix.alias("prefix"), core.alias("core"), suffix.alias("suffix"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size > 10 THEN ['minor', 'medium', 'major', NULL][p_partkey % 4 + 1] END AS class FROM part WHERE p_partkey % 7 > 0
UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 7 = 0""")
def contour_class(spark, sf_dir):
    key = F.col("p_partkey")
    ext = F.element_at(F.array(*map(F.lit, ("elevation_minor", "elevation_medium", "elevation_major", "other"))), (key % 4 + 1).cast("int"))
    part = table(spark, sf_dir, "part")
    return part.select(key.alias("id"), composites.contour_class(F.when(key % 7 > 0, "elevation"), ext, ((F.col("p_size") - 10) * 5).cast("string")).alias("class"))


# Rule families over tags made from the tables ----------------------------------------

def pick(column, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (column % len(values) + 1).cast("int"))


def tagged(spark, sf_dir, tags: dict) -> DataFrame:
    """id and tags of every part; values are columns over p_partkey and p_size."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in tags.items()])
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("tags"))


KEY, SIZE = (lambda: F.col("p_partkey")), (lambda: F.col("p_size"))


@query("""WITH p AS (SELECT p_partkey AS id, ['forest', 'forrest', 'residential', 'meadow', 'industrial', 'quarry', 'none'][p_partkey % 7 + 1] AS landuse, CASE WHEN p_size % 4 = 1 THEN 'broadleaved' WHEN p_size % 4 = 2 THEN 'needleleaved' END AS leaf, CASE WHEN p_partkey % 11 = 0 THEN 'wood' END AS nat FROM part)
SELECT id, CASE WHEN landuse IN ('forest', 'forrest') OR nat IS NOT NULL THEN CASE leaf WHEN 'broadleaved' THEN 21 WHEN 'needleleaved' THEN 80 ELSE 82 END WHEN landuse = 'residential' THEN 2 WHEN landuse = 'meadow' THEN 23 WHEN landuse = 'industrial' THEN 12 ELSE 18 END AS type,
  CASE WHEN nat IS NULL AND landuse IN ('meadow', 'quarry') THEN 20 ELSE 17 END AS low FROM p WHERE landuse <> 'none' OR nat IS NOT NULL""")
def family_landuse(spark, sf_dir):
    tags = {"landuse": pick(KEY(), ("forest", "forrest", "residential", "meadow", "industrial", "quarry", "none")), "leaf_type": F.when(SIZE() % 4 == 1, "broadleaved").when(SIZE() % 4 == 2, "needleleaved"), "natural": F.when(KEY() % 11 == 0, "wood")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.landuse_areas())).select("id", "type", "low")


@query("""WITH p AS (SELECT p_partkey AS id, p_size % 2 = 0 AS tidal, ['water', 'bare_rock', 'wetland', 'glacier', 'scree', 'sand', 'tree'][p_partkey % 7 + 1] AS nat FROM part)
SELECT id, CASE nat WHEN 'water' THEN 60 WHEN 'bare_rock' THEN 22 WHEN 'glacier' THEN 77 WHEN 'scree' THEN 67 WHEN 'sand' THEN 71 ELSE CASE WHEN tidal THEN 86 ELSE 81 END END AS type, CASE nat WHEN 'water' THEN 16 WHEN 'bare_rock' THEN 17 WHEN 'glacier' THEN 17 ELSE 20 END AS low FROM p WHERE nat <> 'tree'""")
def family_natural(spark, sf_dir):
    tags = {"natural": pick(KEY(), ("water", "bare_rock", "wetland", "glacier", "scree", "sand", "tree")), "wetland": F.when(SIZE() % 2 == 0, "tidalflat")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.natural_areas())).select("id", "type", "low")


@query("""SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN [70, 60, 61, 61][p_size % 4 + 1] WHEN 1 THEN [45, 44, 56, 45][p_size % 4 + 1] ELSE [45, 28, 33, 56][p_size % 4 + 1] END AS type FROM part""")
def family_water_aero_military(spark, sf_dir):
    which = lambda n, values: F.when(KEY() % 3 == n, pick(SIZE(), values))
    tags = {"waterway": which(0, ("riverbank", "dock", "dam", "weir")), "aeroway": which(1, ("aerodrome", "apron", "terminal", "helipad")), "military": which(2, ("airfield", "barracks", "range", "naval_base"))}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.other_areas())).select("id", "type")


@query("SELECT p_partkey AS id, 37 AS type, CASE WHEN p_size * 8.0 > 150 THEN 22 ELSE 24 END AS low FROM part WHERE p_partkey % 4 < 3 AND p_partkey % 5 > 0")
def family_power(spark, sf_dir):
    tags = {"power": pick(KEY(), ("generator", "station", "plant", "tower")), "building": F.when(KEY() % 5 == 0, "yes")}
    frame = tagged(spark, sf_dir, tags).withColumn("length", F.col("size") * 8.0)
    return plans.apply_rules(frame, parse_rules(rulesets.power_areas()), geometry=("length",)).select("id", "type", "low")


@query("""WITH p AS (SELECT p_partkey AS id, ['substation', 'sub_station', 'plant', 'line'][p_partkey % 4 + 1] AS p, p_partkey % 5 = 0 AS building, p_size * 8.0 > 150 AS long FROM part)
SELECT id, 37 AS type, CASE WHEN long THEN 22 ELSE 24 END AS low FROM p WHERE p <> 'line' AND NOT building UNION ALL SELECT id, 127, 24 FROM p WHERE building OR p IN ('plant', 'line')""")
def family_substations(spark, sf_dir):
    """Substations end an entity, power stations leave it to the rule behind."""
    tags = {"power": pick(KEY(), ("substation", "sub_station", "plant", "line")), "building": F.when(KEY() % 5 == 0, "yes")}
    frame = tagged(spark, sf_dir, tags).withColumn("length", F.col("size") * 8.0)
    return plans.apply_rules(frame, parse_rules(rulesets.power_areas() + "\npower = * [0x7f resolution 24]"), geometry=("length",)).select("id", "type", "low")


@query("""WITH p AS (SELECT p_partkey AS id, p_size AS s, ['motorway', 'primary', 'residential', 'living_street', 'path'][p_partkey % 5 + 1] AS h, p_size % 6 = 0 AS around, CASE WHEN p_partkey % 3 > 0 THEN p_name END AS name, CASE WHEN p_size % 4 > 0 THEN 'A' || p_size || ';B' || p_partkey % 10 END AS ref, p_size % 3 = 1 AS bridge FROM part),
r AS (SELECT *, around AND h IN ('motorway', 'primary', 'residential') AS circle FROM p),
n AS (SELECT *, CASE WHEN circle OR h NOT IN ('motorway', 'primary') THEN name WHEN h = 'motorway' THEN ref ELSE coalesce(name, ref) END AS label FROM r),
f AS (
  SELECT id, label, CASE WHEN circle THEN 12 WHEN h = 'motorway' THEN 1 WHEN h = 'primary' THEN 3 WHEN h = 'residential' THEN 6 ELSE 9 END AS type, CASE h WHEN 'motorway' THEN 4 WHEN 'primary' THEN 2 ELSE 0 END AS road_class,
    CASE WHEN circle THEN CASE h WHEN 'motorway' THEN 5 WHEN 'primary' THEN 2 ELSE 1 END ELSE CASE h WHEN 'motorway' THEN 7 WHEN 'primary' THEN 5 WHEN 'residential' THEN 2 ELSE 0 END END AS road_speed, 24 AS low, 24 AS high FROM n WHERE h <> 'path'
  UNION ALL SELECT id, label, 66569, NULL, NULL, 24, 24 FROM n WHERE h = 'motorway' AND bridge
  UNION ALL SELECT id, label, t, NULL, NULL, lo, hi FROM n, (VALUES (73491, 24, 24), (69386, 22, 23), (69387, 20, 21), (69130, 14, 19)) AS looks(t, lo, hi) WHERE h = 'motorway')
SELECT * FROM f""")
def family_roads(spark, sf_dir):
    tags = {
        "highway": pick(KEY(), ("motorway", "primary", "residential", "living_street", "path")), "junction": F.when(SIZE() % 6 == 0, "roundabout"), "name": F.when(KEY() % 3 > 0, F.col("p_name")),
        "ref": F.when(SIZE() % 4 > 0, F.concat(F.lit("A"), SIZE(), F.lit(";B"), KEY() % 10)), "bridge": F.when(SIZE() % 3 == 1, "yes").when(SIZE() % 3 == 2, "no"),
    }
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.roads())).select("id", "label", "type", "road_class", "road_speed", "low", "high")


@query("""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 > 0 THEN 'A' || p_size || CASE WHEN p_size % 2 = 0 THEN ';B2' ELSE '' END END AS ref, CASE WHEN p_partkey % 4 = 0 THEN 'E1;A2' END AS int_ref FROM part),
l AS (SELECT id, list_distinct(list_filter(list_concat(coalesce(string_split(ref, ';'), []), coalesce(string_split(int_ref, ';'), [])), lambda x: x IS NOT NULL)) AS labels FROM p)
SELECT id, array_to_string(list_sort(labels), '/') AS labels FROM l""")
def family_ref_labels(spark, sf_dir):
    tags = {"ref": F.when(SIZE() % 3 > 0, F.concat(F.lit("A"), SIZE(), F.when(SIZE() % 2 == 0, ";B2").otherwise(""))), "int_ref": F.when(KEY() % 4 == 0, "E1;A2"), "highway": F.lit("x")}
    found = plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules("highway = * [0x1]\n" + rulesets.labels()))
    return found.select("id", F.array_join(F.array_sort("labels"), "/").alias("labels"))


@query("""WITH p AS (SELECT p_partkey AS id, ['rail', 'tram', 'subway', 'abandoned'][p_partkey % 4 + 1] AS r, p_size % 3 = 0 AS bridge, p_size % 5 = 0 AS tunnel FROM part)
SELECT id, CASE r WHEN 'tram' THEN 66565 ELSE 66567 END AS type, 24 AS low FROM p WHERE r <> 'abandoned' AND bridge
UNION ALL SELECT id, CASE r WHEN 'rail' THEN CASE WHEN tunnel THEN 73993 ELSE 73987 END WHEN 'tram' THEN CASE WHEN tunnel THEN 73998 ELSE 20 END ELSE CASE WHEN tunnel THEN 73991 ELSE 73994 END END, CASE r WHEN 'tram' THEN 23 ELSE 22 END FROM p WHERE r <> 'abandoned'""")
def family_railways(spark, sf_dir):
    tags = {"railway": pick(KEY(), ("rail", "tram", "subway", "abandoned")), "bridge": F.when(SIZE() % 3 == 0, "yes").when(SIZE() % 3 == 1, "no"), "tunnel": F.when(SIZE() % 5 == 0, "yes")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.railways())).select("id", "type", "low")


@query("""WITH p AS (SELECT p_partkey AS id, ['river', 'canal', 'stream', 'drain'][p_partkey % 4 + 1] AS w, p_size % 3 = 0 AS tunnel FROM part)
SELECT id, CASE WHEN tunnel THEN t ELSE o END AS type, low, high FROM p JOIN (VALUES ('canal', 24, 24, 38, 73754), ('canal', 23, 23, 65794, 73752), ('canal', 21, 22, 65795, 73750), ('drain', 24, 24, 73988, 73756), ('river', 24, 24, 31, 73753), ('river', 23, 23, 65792, 73751), ('river', 21, 22, 65793, 73749), ('stream', 24, 24, 24, 73757)) AS l(w, low, high, o, t) USING (w)""")
def family_waterways(spark, sf_dir):
    tags = {"waterway": pick(KEY(), ("river", "canal", "stream", "drain")), "tunnel": F.when(SIZE() % 3 == 0, "culvert")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.waterways())).select("id", "type", "low", "high")


@query("""WITH p AS (SELECT p_partkey AS id, ['rail', 'disused', 'narrow_gauge', 'funicular', 'preserved', 'platform'][p_partkey % 6 + 1] AS r, p_size % 2 = 0 AS s, p_size % 3 = 0 AS b, p_size % 5 = 0 AS t, p_size % 4 AS a FROM part)
SELECT id, 66567 AS type, 24 AS low FROM p WHERE r <> 'platform' AND b
UNION ALL SELECT id, CASE WHEN t THEN 73993 WHEN r = 'disused' OR s THEN 74003 ELSE 73987 END, CASE WHEN r = 'disused' THEN 24 WHEN s THEN 23 ELSE 22 END FROM p WHERE r <> 'platform'
UNION ALL SELECT id, 69149, 24 FROM p WHERE r = 'platform' AND a < 3""")
def family_sidings(spark, sf_dir):
    tags = {"railway": pick(KEY(), ("rail", "disused", "narrow_gauge", "funicular", "preserved", "platform")), "service": F.when(SIZE() % 2 == 0, "yard"), "bridge": F.when(SIZE() % 3 == 0, "viaduct").when(SIZE() % 3 == 1, "no")}
    tags |= {"tunnel": F.when(SIZE() % 5 == 0, "yes"), "area": F.when(SIZE() % 4 == 3, "yes").when(SIZE() % 4 == 2, "no")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.railways())).select("id", "type", "low")


@query("""WITH p AS (SELECT p_partkey AS id, ['river', 'stream', 'drain', 'ditch', 'dam', 'weir'][p_partkey % 6 + 1] AS w, p_size % 3 = 0 AS tunnel, p_size % 2 = 0 AS building FROM part)
SELECT id, CASE WHEN tunnel THEN t ELSE o END AS type, low, high FROM p JOIN (VALUES ('ditch', 24, 24, 65802, 73755), ('drain', 24, 24, 73988, 73756), ('river', 24, 24, 31, 73753), ('river', 23, 23, 65792, 73751), ('river', 21, 22, 65793, 73749), ('stream', 24, 24, 24, 73757)) AS l(w, low, high, o, t) USING (w)
UNION ALL SELECT id, 65804, 23, 24 FROM p WHERE w = 'dam' UNION ALL SELECT id, 73989, 22, 24 FROM p WHERE w = 'weir' AND NOT building UNION ALL SELECT id, 127, 24, 24 FROM p WHERE w IN ('ditch', 'dam', 'weir')""")
def family_waterways_end(spark, sf_dir):
    """Waterways with a rule behind them, which those that end an entity keep from it."""
    tags = {"waterway": pick(KEY(), ("river", "stream", "drain", "ditch", "dam", "weir")), "tunnel": F.when(SIZE() % 3 == 0, "culvert"), "building": F.when(SIZE() % 2 == 0, "yes")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.waterways() + "\nwaterway = * [0x7f resolution 24]")).select("id", "type", "low", "high")


@query("""WITH p AS (SELECT p_partkey AS id, ['gondola', 't-bar', 'rope_tow', 'goods', 'station'][p_partkey % 5 + 1] AS a FROM part)
SELECT id, 17 AS type, 0 AS road_class FROM p WHERE a IN ('gondola', 't-bar') UNION ALL SELECT id, CASE a WHEN 'gondola' THEN 73503 WHEN 'goods' THEN 73997 ELSE 73502 END, NULL FROM p WHERE a <> 'station'""")
def family_lifts(spark, sf_dir):
    tags = {"aerialway": pick(KEY(), ("gondola", "t-bar", "rope_tow", "goods", "station"))}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.lifts())).select("id", "type", "road_class")


@query("""SELECT p_partkey AS id, p_name AS label, CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_size * 40000 > 1000000 OR p_size % 7 = 0 THEN 256 ELSE 512 END WHEN 1 THEN 3072 ELSE 3328 END AS type,
  CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_size * 40000 > 1000000 OR p_size % 7 = 0 THEN 12 ELSE 14 END WHEN 1 THEN 21 ELSE 24 END AS low FROM part""")
def family_places(spark, sf_dir):
    tags = {"place": pick(KEY(), ("city", "village", "hamlet", "allotments")), "name": F.col("p_name"), "population": SIZE() * 40000, "capital": F.when(SIZE() % 7 == 0, "true")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.places())).select("id", "label", "type", "low")


@query("""WITH p AS (SELECT p_partkey AS id, p_partkey % 2 = 0 AS hut, CASE WHEN p_size % 3 > 0 THEN p_name END AS name, CASE WHEN p_size % 2 = 0 THEN p_size * 40 END AS ele, CASE WHEN p_size % 5 = 0 THEN p_brand END AS brand, CASE WHEN p_size % 7 = 0 THEN 'op' END AS op FROM part)
SELECT id, CASE WHEN hut THEN 18435 ELSE 12033 END AS type, CASE WHEN hut THEN coalesce(name, 'Alpine hut') || CASE WHEN ele IS NOT NULL THEN ' (' || ele || ')' ELSE '' END ELSE coalesce(brand, op, name, 'Fuel station') END AS label FROM p""")
def family_huts_and_fuel(spark, sf_dir):
    tags = {"tourism": F.when(KEY() % 2 == 0, "alpine_hut"), "amenity": F.when(KEY() % 2 == 1, "fuel"), "name": F.when(SIZE() % 3 > 0, F.col("p_name")), "ele": F.when(SIZE() % 2 == 0, SIZE() * 40), "brand": F.when(SIZE() % 5 == 0, F.col("p_brand")), "operator": F.when(SIZE() % 7 == 0, "op")}
    return plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules(rulesets.huts_and_fuel({"ALPINEHUT": "Alpine hut", "FUELSTATION": "Fuel station"}))).select("id", "type", "label")


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'EN ' || p_name WHEN p_size % 3 = 0 THEN 'INT' ELSE p_name END AS name FROM part")
def name_tag_list(spark, sf_dir):
    tags = {"name": F.col("p_name"), "name:en": F.when(SIZE() % 2 == 0, F.concat(F.lit("EN "), F.col("p_name"))), "int_name": F.when(SIZE() % 3 == 0, "INT")}
    return tagged(spark, sf_dir, tags).select("id", F.element_at(composites.prefer_names(F.col("tags"), ("name:en", "int_name", "name")), F.lit("name")).alias("name"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN p_size % 8 WHEN p_size % 3 = 1 THEN greatest(0, least(7, 5 + p_size % 9 - 4)) ELSE 5 END::INTEGER AS road_speed, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 5 WHEN p_partkey % 3 = 1 THEN greatest(0, least(4, 2 - 1 - p_partkey % 2)) ELSE 2 END::INTEGER AS road_class FROM part""")
def control_road_class(spark, sf_dir):
    signed = F.concat(F.when(SIZE() % 9 - 4 >= 0, "+").otherwise(""), (SIZE() % 9 - 4).cast("string"))
    tags = {"highway": F.lit("primary"), "x:road-speed-class": F.when(SIZE() % 3 == 0, SIZE() % 8), "x:road-speed": F.when(SIZE() % 3 == 1, signed), "x:road-class": F.when(KEY() % 3 == 0, KEY() % 5).when(KEY() % 3 == 1, F.concat(F.lit("-"), 1 + KEY() % 2))}
    found = plans.apply_rules(tagged(spark, sf_dir, tags), parse_rules("highway = primary [0x03 road_class=2 road_speed=5]"))
    return composites.road_control(found, "x:").select("id", "road_speed", "road_class")


# Translations -----------------------------------------------------------------------

WORDS = [(0, "PROMO", None, "Angebot"), (1, "PROMO", "EN", "Offer"), (2, "SMALL", None, "Klein"), (3, "SMALL", "FR", "Petit"), (4, "LARGE", "EN", "Large"), (5, "LARGE", None, "Gross"), (6, "PROMO", "EN", "Special"), (7, "MEDIUM", None, "Mittel")]
WORDS_SQL = "w(ord, key, lang, text) AS (VALUES (0, 'PROMO', NULL, 'Angebot'), (1, 'PROMO', 'EN', 'Offer'), (2, 'SMALL', NULL, 'Klein'), (3, 'SMALL', 'FR', 'Petit'), (4, 'LARGE', 'EN', 'Large'), (5, 'LARGE', NULL, 'Gross'), (6, 'PROMO', 'EN', 'Special'), (7, 'MEDIUM', NULL, 'Mittel'))"


def translations(spark) -> DataFrame:
    return spark.createDataFrame(WORDS, "ord int, key string, lang string, text string")


@query(f"WITH {WORDS_SQL}, b AS (SELECT key, text FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY lang IS NULL, ord DESC) r FROM w WHERE lang IS NULL OR lang = 'EN') WHERE r = 1) SELECT p_partkey AS id, coalesce(b.text, p_type) AS label FROM part LEFT JOIN b ON b.key = p_type")
def i18n_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("key"))
    return part.join(translate.resolve(translations(spark), "EN"), "key", "left").select("id", F.coalesce("text", "key").alias("label"))


LANGUAGES_SQL = "w AS (SELECT p_partkey AS ord, p_type AS key, CASE p_partkey % 4 WHEN 0 THEN 'EN' WHEN 1 THEN 'FR' WHEN 2 THEN 'DE' END AS lang, p_name AS text FROM part)"


def part_names(spark, sf_dir) -> DataFrame:
    """Names of parts as a translation table: a quarter of them in each of three languages, the others in none."""
    lang = F.get(F.array(*[F.lit(x) for x in ("EN", "FR", "DE", None)]), (F.col("p_partkey") % 4).cast("int"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_type").alias("key"), lang.alias("lang"), F.col("p_name").alias("text"))


@query(f"WITH {LANGUAGES_SQL} SELECT * FROM w UNION ALL SELECT ord, key, 'PL', text FROM w WHERE lang = 'EN'")
def i18n_add_lang(spark, sf_dir):
    return translate.change_languages(part_names(spark, sf_dir), add="PL", copy="EN")


@query(f"WITH {LANGUAGES_SQL} SELECT * FROM w WHERE lang IS DISTINCT FROM 'EN'")
def i18n_remove_lang(spark, sf_dir):
    return translate.change_languages(part_names(spark, sf_dir), remove="EN")


@query("SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN p_name ELSE p_type END AS label FROM part")
def symbol_language(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 25, F.create_map(F.lit("0x04"), "p_name", F.lit("0x00"), "p_type")).otherwise(F.create_map(F.lit("0x07"), F.lit("other"), F.lit("0x00"), F.col("p_type"))).alias("strings"))
    added = translate.add_symbol_language(F.col("strings"), "0x15", "0x04")
    return part.withColumn("strings", added).select("id", translate.symbol_text(F.col("strings"), "0x15").alias("label"))


# Geometry -----------------------------------------------------------------------------

POINTS_SQL = with_views("node", "way_node") + ", pt AS (SELECT way_id, seq, node_id, lat_e7, lon_e7 FROM way_node JOIN node ON node.id = node_id) "


def points(spark, sf_dir) -> DataFrame:
    return geometry.way_points(views.way_nodes(spark, sf_dir), views.nodes(spark, sf_dir))


@query(POINTS_SQL + 'SELECT way_id, min(lon_e7) AS "left", min(lat_e7) AS bottom, max(lon_e7) AS "right", max(lat_e7) AS top FROM pt GROUP BY way_id')
def way_bbox(spark, sf_dir):
    return geometry.way_bbox(points(spark, sf_dir))


@query(POINTS_SQL + "SELECT way_id, count(*)::INTEGER AS n, string_agg(lon_e7 || ' ' || lat_e7, ',' ORDER BY seq) AS line FROM pt GROUP BY way_id")
def way_linestring(spark, sf_dir):
    lines = geometry.way_lines(points(spark, sf_dir))
    return lines.select("way_id", F.size("points").alias("n"), F.array_join(F.transform("points", lambda p: F.concat_ws(" ", p["lon_e7"].cast("string"), p["lat_e7"].cast("string"))), ",").alias("line"))


@query(POINTS_SQL + "SELECT way_id, CASE WHEN arg_min(node_id, seq) = arg_max(node_id, seq) AND count(*) >= 3 THEN 'polygon' ELSE 'line' END AS kind FROM pt GROUP BY way_id")
def closed_way_polygon(spark, sf_dir):
    return geometry.way_lines(points(spark, sf_dir)).select("way_id", geometry.kind(F.col("points")).alias("kind"))


@query(POINTS_SQL + """, s AS (SELECT way_id, radians(lat_e7 / 1e7) AS la, radians(lon_e7 / 1e7) AS lo, lead(radians(lat_e7 / 1e7)) OVER w AS lb, lead(radians(lon_e7 / 1e7)) OVER w AS lp FROM pt WINDOW w AS (PARTITION BY way_id ORDER BY seq))
SELECT way_id, coalesce(round(sum(2 * 6371000.0 * asin(sqrt(least(pow(sin((lb - la) / 2), 2) + cos(la) * cos(lb) * pow(sin((lp - lo) / 2), 2), 1.0)))) FILTER (lb IS NOT NULL))::BIGINT, 0) AS metres FROM s GROUP BY way_id""")
def way_length(spark, sf_dir):
    return geometry.way_lines(points(spark, sf_dir)).select("way_id", F.round(geometry.length(F.col("points"))).cast("long").alias("metres"))


@query(POINTS_SQL + """, s AS (SELECT way_id, lat_e7 // 1000 AS la, lon_e7 // 1000 AS lo, lead(lat_e7 // 1000) OVER w AS lb, lead(lon_e7 // 1000) OVER w AS lp FROM pt WINDOW w AS (PARTITION BY way_id ORDER BY seq))
SELECT way_id, coalesce(sum(lo * lb - lp * la), 0)::BIGINT AS area2 FROM s GROUP BY way_id""")
def shoelace_area(spark, sf_dir):
    return geometry.way_lines(points(spark, sf_dir)).select("way_id", geometry.area2_micro(F.col("points")).alias("area2"))


@query(with_views("node") + """, q AS (SELECT id, round((lon_e7 / 1e7 + 180) * 65535 / 360)::BIGINT AS x, round((lat_e7 / 1e7 + 90) * 65535 / 180)::BIGINT AS y FROM node)
SELECT id, (SELECT sum((((x >> i) & 1) << (2 * i + 1)) + (((y >> i) & 1) << (2 * i)))::BIGINT FROM range(16) t(i)) AS tile FROM q""")
def tile_morton(spark, sf_dir):
    return views.nodes(spark, sf_dir).select("id", geometry.morton(F.col("lat_e7"), F.col("lon_e7")).alias("tile"))


@query(with_views("node") + """, q AS (SELECT id, lon_e7 / 1e7 AS lon, radians(greatest(least(lat_e7 / 1e7, 85.0511), -85.0511)) AS lat FROM node)
SELECT id, greatest(least(floor(round((lon + 180) / 360 * 4096, 6)), 4095), 0)::BIGINT AS x, greatest(least(floor(round((1 - ln(tan(lat) + 1 / cos(lat)) / 3.141592653589793::DOUBLE) / 2 * 4096, 6)), 4095), 0)::BIGINT AS y FROM q""")
def tile_slippy(spark, sf_dir):
    x, y = geometry.slippy(F.col("lat_e7"), F.col("lon_e7"), 12)
    return views.nodes(spark, sf_dir).select("id", x.alias("x"), y.alias("y"))


@query("SELECT o_orderkey AS id, CASE WHEN v >= 2147483648 THEN v - 4294967296 ELSE v END AS xid FROM (SELECT o_orderkey, (o_orderkey * 2654435761) % 4294967296 AS v FROM orders)")
def xid_wrap(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), geometry.wrap32((F.col("o_orderkey") * 2654435761) % 4294967296).alias("xid"))


# Partitioning ---------------------------------------------------------------------------

CELL = 450_000_000
AREAS = [(1, -1800000000, -900000000, 0, 0), (2, 0, -900000000, 1800000001, 0), (3, -1800000000, 0, 900000000, 900000001), (4, 900000000, 0, 1800000001, 900000001)]
AREAS_SQL = "area(tile_id, l, b, r, t) AS (VALUES (1, -1800000000, -900000000, 0, 0), (2, 0, -900000000, 1800000001, 0), (3, -1800000000, 0, 900000000, 900000001), (4, 900000000, 0, 1800000001, 900000001))"
TILED_SQL = with_views("node", "way_node") + f", {AREAS_SQL}, nt AS (SELECT id, tile_id::BIGINT AS tile_id FROM node JOIN area ON lon_e7 >= l AND lon_e7 < r AND lat_e7 >= b AND lat_e7 < t) "


@query(with_views("node") + "SELECT floor((lon_e7 + 1800000000) / 450000000)::INTEGER AS cx, floor((lat_e7 + 900000000) / 450000000)::INTEGER AS cy, count(*)::BIGINT AS n FROM node GROUP BY ALL")
def density_histogram(spark, sf_dir):
    return partition.density(views.nodes(spark, sf_dir), CELL)


@query()
def kd_split(spark, sf_dir):
    """The tiles that a histogram at a fine grid splits into; the histogram has at most one row a grid cell."""
    cell_e7 = 100_000_000
    histogram = [tuple(r) for r in partition.density(views.nodes(spark, sf_dir), cell_e7).collect()]
    most = max(1, sum(h[2] for h in histogram) // 16)
    return partition.areas_table(spark, partition.split(histogram, most, cell_e7))


#: A rectilinear polygon off the grid of CELL: a U with a step.
STEPPED = [(-1700000001, -800000003), (1500000007, -800000003), (1500000007, 700000001), (600000000, 700000001), (600000000, -100000000), (-400000000, -100000000), (-400000000, 650000000), (-900000000, 650000000), (-900000000, 300000011), (-1700000001, 300000011)]
STEPPED_SQL = "box(box, l, b, r, t) AS (VALUES (1, -1700000001, -800000003, -900000000, 300000011), (2, -900000000, -800000003, -400000000, 650000000), (3, -400000000, -800000003, 600000000, -100000000), (4, 600000000, -800000003, 1500000007, 700000001))"


@query(with_views("node") + f", {STEPPED_SQL}, kept AS (SELECT floor((lon_e7 + 1800000000) / 100000000)::INTEGER AS cx, floor((lat_e7 + 900000000) / 100000000)::INTEGER AS cy, count(*) AS n FROM node GROUP BY 1, 2) SELECT cx, cy, n FROM kept JOIN box ON cx::BIGINT * 100000000 - 1750000000 >= l AND cx::BIGINT * 100000000 - 1750000000 < r AND cy::BIGINT * 100000000 - 850000000 >= b AND cy::BIGINT * 100000000 - 850000000 < t")
def density_mask(spark, sf_dir):
    return partition.mask(partition.density(views.nodes(spark, sf_dir), 100_000_000), regions.ring_table(spark, [STEPPED]), 100_000_000)


@query(with_views("node") + f", {STEPPED_SQL} SELECT box::BIGINT AS box, (r - l)::BIGINT * (t - b)::BIGINT AS area, (SELECT count(*) FROM node WHERE lon_e7 >= l AND lon_e7 < r AND lat_e7 >= b AND lat_e7 < t) AS n FROM box")
def rectilinear_fit(spark, sf_dir):
    """For each rectangle of the polygon the summed area and nodes of its tiles: they fill it exactly."""
    tiles = partition.fit(views.nodes(spark, sf_dir), partition.rectangles(STEPPED), 64, 20_000_000)
    return tiles.groupBy("box").agg(F.sum((F.col("right") - F.col("left")) * (F.col("top") - F.col("bottom"))).alias("area"), F.sum("n").alias("n"))


@query(TILED_SQL + "SELECT id, tile_id FROM nt")
def tile_assign(spark, sf_dir):
    return partition.assign(views.nodes(spark, sf_dir), partition.areas_table(spark, AREAS), CELL).select("id", "tile_id")


@query(with_views("node") + f", {AREAS_SQL} SELECT id, tile_id::BIGINT AS tile_id FROM node JOIN area ON lon_e7 >= l - 50000000 AND lon_e7 < r + 50000000 AND lat_e7 >= b - 50000000 AND lat_e7 < t + 50000000")
def tile_overlap(spark, sf_dir):
    return partition.assign(views.nodes(spark, sf_dir), partition.areas_table(spark, AREAS), CELL, overlap_e7=50_000_000).select("id", "tile_id")


@query(TILED_SQL + "SELECT DISTINCT way_id, tile_id FROM way_node JOIN nt ON nt.id = node_id")
def way_tiles(spark, sf_dir):
    tiles = partition.assign(views.nodes(spark, sf_dir), partition.areas_table(spark, AREAS), CELL)
    return partition.way_tiles(views.way_nodes(spark, sf_dir), tiles)


@query(TILED_SQL + "SELECT DISTINCT o_custkey AS relation, tile_id FROM orders JOIN way_node ON way_id = o_orderkey JOIN nt ON nt.id = node_id")
def relation_tiles(spark, sf_dir):
    tiles = partition.assign(views.nodes(spark, sf_dir), partition.areas_table(spark, AREAS), CELL)
    of_ways = partition.way_tiles(views.way_nodes(spark, sf_dir), tiles)
    return views.ways(spark, sf_dir).select("user_id", F.col("id").alias("way_id")).join(of_ways, "way_id").select(F.col("user_id").alias("relation"), "tile_id").distinct()


@query(POINTS_SQL + f", {AREAS_SQL}, box AS (SELECT way_id, min(lon_e7) AS x1, min(lat_e7) AS y1, max(lon_e7) AS x2, max(lat_e7) AS y2 FROM pt GROUP BY way_id) SELECT way_id, tile_id::BIGINT AS tile_id FROM box JOIN area ON x1 < r AND x2 >= l AND y1 < t AND y2 >= b")
def tile_closure(spark, sf_dir):
    return partition.bbox_tiles(geometry.way_bbox(points(spark, sf_dir)), partition.areas_table(spark, AREAS), "way_id", CELL)


PLACES_SQL = "place AS (SELECT s_name AS name, ((s_suppkey * 5003) % 1800001 - 900000) * 1000 AS lat_e7, ((s_suppkey * 70001) % 3600001 - 1800000) * 1000 AS lon_e7 FROM supplier)"


@query(with_views("node") + f", {PLACES_SQL} SELECT id, arg_min(name, ((node.lat_e7 - p.lat_e7)::DOUBLE * (node.lat_e7 - p.lat_e7) + (node.lon_e7 - p.lon_e7)::DOUBLE * (node.lon_e7 - p.lon_e7), name)) AS place FROM node, place p GROUP BY id")
def city_nearest(spark, sf_dir):
    places = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), views.e7("s_suppkey", 5003, 1800001, 900000).alias("lat_e7"), views.e7("s_suppkey", 70001, 3600001, 1800000).alias("lon_e7"))
    return partition.nearest(views.nodes(spark, sf_dir), places, "id", "name")


# Entity dataflow ---------------------------------------------------------------------------

BOX = (-900_000_000, -450_000_000, 1_200_000_000, 600_000_000)
INSIDE = "lon_e7 BETWEEN -900000000 AND 1200000000 AND lat_e7 BETWEEN -450000000 AND 600000000"
RING = [(-1_000_000_000, -500_000_000), (1_200_000_000, -300_000_000), (300_000_000, 100_000_000), (900_000_000, 800_000_000), (-700_000_000, 400_000_000)]


@query("SELECT p_partkey AS id FROM part WHERE p_type = 'PROMO' OR p_brand = 'Brand#13'")
def tag_filter(spark, sf_dir):
    return entities.tag_filter(views.nodes(spark, sf_dir), keys=("nowhere",), pairs=(("ptype", "PROMO"), ("brand", "Brand#13"))).select("id")


@query("SELECT p_partkey AS id FROM part SEMI JOIN lineitem ON l_partkey = p_partkey")
def used_node(spark, sf_dir):
    return entities.used(views.nodes(spark, sf_dir), views.way_nodes(spark, sf_dir).select("node_id")).select("id")


@query("SELECT o_orderkey AS id FROM orders SEMI JOIN customer ON c_custkey = o_custkey AND c_mktsegment = 'FURNITURE'")
def used_way(spark, sf_dir):
    owners = table(spark, sf_dir, "customer").where("c_mktsegment = 'FURNITURE'").select(F.col("c_custkey").alias("user_id"))
    return entities.used(views.ways(spark, sf_dir), owners, id_col="user_id").select("id")


@query(with_views("node") + f"SELECT id FROM node WHERE {INSIDE}")
def bbox_clip(spark, sf_dir):
    return entities.bbox_clip(views.nodes(spark, sf_dir), *BOX).select("id")


@query(with_views("node", "way_node") + f", w AS (SELECT DISTINCT way_id FROM way_node JOIN node ON id = node_id WHERE {INSIDE}) SELECT way_id, count(*)::BIGINT AS n FROM way_node SEMI JOIN w USING (way_id) GROUP BY way_id")
def complete_ways(spark, sf_dir):
    nodes = entities.bbox_clip(views.nodes(spark, sf_dir), *BOX)
    _, refs = entities.clip_ways(views.ways(spark, sf_dir), views.way_nodes(spark, sf_dir), nodes, complete=True)
    return refs.groupBy("way_id").agg(F.count(F.lit(1)).alias("n"))


@query(with_views("node") + ", e(x1, y1, x2, y2) AS (VALUES (-1000000000, -500000000, 1200000000, -300000000), (1200000000, -300000000, 300000000, 100000000), (300000000, 100000000, 900000000, 800000000), (900000000, 800000000, -700000000, 400000000), (-700000000, 400000000, -1000000000, -500000000)) SELECT id FROM node, (SELECT x1::BIGINT AS x1, y1::BIGINT AS y1, x2::BIGINT AS x2, y2::BIGINT AS y2 FROM e) WHERE (y1 > lat_e7) <> (y2 > lat_e7) AND CASE WHEN y1 < y2 THEN (lon_e7 - x1)::HUGEINT * (y2 - y1) < (lat_e7 - y1)::HUGEINT * (x2 - x1) ELSE (lon_e7 - x2)::HUGEINT * (y1 - y2) < (lat_e7 - y2)::HUGEINT * (x1 - x2) END GROUP BY id HAVING count(*) % 2 = 1")
def polygon_clip(spark, sf_dir):
    return entities.polygon_clip(views.nodes(spark, sf_dir), [RING]).select("id")


COAST_POINTS = 3000


def coast() -> list[tuple[int, int]]:
    """A ring of 3000 vertices: the border of a square with a tooth at each, by a rule that SQL has too."""
    out = []
    for i in range(COAST_POINTS):
        t, d = (i % 750) * 4 * 1_600_000_000 // COAST_POINTS - 800_000_000, (i * 7919 % 1000) * 500_000
        out.append([(t, d - 800_000_000), (800_000_000 - d, t), (-t, 800_000_000 - d), (d - 800_000_000, -t)][i // 750])
    return out


COAST_SQL = """v AS (SELECT i, (i % 750) * 4 * 1600000000 // 3000 - 800000000 AS t, (i * 7919 % 1000) * 500000 AS d FROM range(3000) r(i)),
p AS (SELECT i, CASE i // 750 WHEN 0 THEN t WHEN 1 THEN 800000000 - d WHEN 2 THEN -t ELSE d - 800000000 END AS x,
             CASE i // 750 WHEN 0 THEN d - 800000000 WHEN 1 THEN t WHEN 2 THEN 800000000 - d ELSE -t END AS y FROM v),
e AS (SELECT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM p a JOIN p b ON b.i = (a.i + 1) % 3000) """


@query(with_views("node") + ", " + COAST_SQL + """SELECT id FROM node, e WHERE (y1 > lat_e7) <> (y2 > lat_e7)
AND CASE WHEN y1 < y2 THEN (lon_e7 - x1)::HUGEINT * (y2 - y1) < (lat_e7 - y1)::HUGEINT * (x2 - x1) ELSE (lon_e7 - x2)::HUGEINT * (y1 - y2) < (lat_e7 - y2)::HUGEINT * (x1 - x2) END
GROUP BY id HAVING count(*) % 2 = 1""")
def polygon_clip_coast(spark, sf_dir):
    """Clip by a ring of the size that real ones have."""
    return entities.polygon_clip(views.nodes(spark, sf_dir), [coast()]).select("id")


@query(POINTS_SQL + f""", {AREAS_SQL}, s AS (
  SELECT way_id, seq, lon_e7 AS x1, lat_e7 AS y1, lead(lon_e7) OVER w AS x2, lead(lat_e7) OVER w AS y2 FROM pt WINDOW w AS (PARTITION BY way_id ORDER BY seq)),
g AS (SELECT * FROM s WHERE x2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)),
c AS (
  SELECT way_id, seq, x1, y1, x2, y2, 0::HUGEINT AS n, 1::HUGEINT AS m FROM g
  UNION ALL SELECT way_id, seq, x1, y1, x2, y2, 1, 1 FROM g
  UNION SELECT way_id, seq, x1, y1, x2, y2, abs(v - x1), abs(x2 - x1) FROM g, (SELECT unnest([l, r]) AS v FROM area) WHERE (x1 < v AND v < x2) OR (x2 < v AND v < x1)
  UNION SELECT way_id, seq, x1, y1, x2, y2, abs(v - y1), abs(y2 - y1) FROM g, (SELECT unnest([b, t]) AS v FROM area) WHERE (y1 < v AND v < y2) OR (y2 < v AND v < y1)),
k AS (
  SELECT way_id, seq, n::DOUBLE / m::DOUBLE AS f, x1 + n::DOUBLE / m::DOUBLE * (x2 - x1) AS fx, y1 + n::DOUBLE / m::DOUBLE * (y2 - y1) AS fy,
         x1 + ((2 * n * (x2 - x1) + m + 2 * m * 10000000000) // (2 * m) - 10000000000)::BIGINT AS x, y1 + ((2 * n * (y2 - y1) + m + 2 * m * 10000000000) // (2 * m) - 10000000000)::BIGINT AS y FROM c),
h AS (SELECT *, lead(x) OVER w AS xb, lead(y) OVER w AS yb, (fx + lead(fx) OVER w) / 2 AS mx, (fy + lead(fy) OVER w) / 2 AS my FROM k WINDOW w AS (PARTITION BY way_id, seq ORDER BY f))
SELECT way_id, tile_id::BIGINT AS tile_id, count(DISTINCT seq)::BIGINT AS n_segments, sum(abs(xb - x) + abs(yb - y))::BIGINT AS length_e7
FROM h JOIN area ON mx >= l AND mx < r AND my >= b AND my < t WHERE xb IS NOT NULL GROUP BY ALL""")
def tile_cut_lines(spark, sf_dir):
    """Ways cut on the borders of tiles: segments and length of each way in each tile."""
    cut = cutting.cut_segments(cutting.segments(points(spark, sf_dir)), partition.areas_table(spark, AREAS), CELL)
    length = F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))
    return cut.groupBy("way_id", "tile_id").agg(F.count(F.lit(1)).alias("n_segments"), F.sum(length).alias("length_e7"))


@query("SELECT p_partkey AS id, 'pname,size' AS keys FROM part")
def remove_tags(spark, sf_dir):
    got = entities.tag_sort(entities.remove_tags(views.nodes(spark, sf_dir), keys=("brand",), prefixes=("pt",)))
    return got.select("id", F.array_join(F.map_keys("tags"), ",").alias("keys"))


@query("SELECT l_orderkey AS way_id, l_partkey AS node_id FROM lineitem ANTI JOIN (SELECT * FROM part WHERE p_size <= 40) p ON p_partkey = l_partkey")
def integrity_report(spark, sf_dir):
    kept = table(spark, sf_dir, "part").where("p_size <= 40").select(F.col("p_partkey").alias("id"))
    return entities.integrity_report(views.way_nodes(spark, sf_dir), kept, ["way_id"], "node_id")


@query("SELECT o_custkey AS user_id, count(*)::BIGINT AS n FROM orders GROUP BY ROLLUP (o_custkey)")
def user_report_rollup(spark, sf_dir):
    return entities.user_report(views.ways(spark, sf_dir))


@query(with_views("node") + 'SELECT min(lon_e7) AS "left", min(lat_e7) AS bottom, max(lon_e7) AS "right", max(lat_e7) AS top FROM node')
def bound_compute(spark, sf_dir):
    n = views.nodes(spark, sf_dir)
    return entities.merge_bounds(entities.bound(n.where("id % 2 = 0")), entities.bound(n.where("id % 2 = 1")))


@query("SELECT 'node' AS type, p_partkey AS id, 1 AS version FROM part UNION ALL SELECT 'way', o_orderkey, 1 FROM orders")
def sort_type_id(spark, sf_dir):
    n = table(spark, sf_dir, "part").select(F.lit("node").alias("type"), F.col("p_partkey").alias("id"), F.lit(1).alias("version"))
    w = table(spark, sf_dir, "orders").select(F.lit("way").alias("type"), F.col("o_orderkey").alias("id"), F.lit(1).alias("version"))
    return entities.sort_entities(w.unionByName(n))


LAST = "row_number() OVER (PARTITION BY id ORDER BY version DESC, ts DESC) = 1"


@query(with_views("change") + f"SELECT id, version, action, ts FROM change QUALIFY {LAST}")
def simplify_change(spark, sf_dir):
    return entities.simplify_change(views.changes(spark, sf_dir)).select("id", "version", "action", "ts")


@query(with_views("change") + f"SELECT id, version, k FROM change WHERE action <> 'delete' QUALIFY {LAST}")
def flatten_latest(spark, sf_dir):
    return entities.flatten(views.changes(spark, sf_dir).where("action <> 'delete'")).select("id", "version", "k")


@query(with_views("change") + f"SELECT id, version, k FROM change QUALIFY {LAST}")
def merge_dedup(spark, sf_dir):
    c = views.changes(spark, sf_dir)
    return entities.merge(c.where("version % 2 = 0"), c.where("version % 3 <> 1").unionByName(c.where("version % 3 = 1"))).select("id", "version", "k")


@query(with_views("change") + "SELECT id, version, action FROM change WHERE action = 'create' UNION ALL SELECT id, version, action FROM change WHERE action = 'delete'")
def append_change(spark, sf_dir):
    c = views.changes(spark, sf_dir).select("id", "version", "action")
    return entities.append_change(c.where("action = 'create'"), c.where("action = 'delete'"))


def snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    new = o.where("id % 7 <> 0").withColumn("status", F.when(F.col("id") % 5 == 0, "X").otherwise(F.col("status"))).withColumn("priority", F.when(F.col("id") % 11 != 0, F.col("priority")))
    return o.where("id % 3 <> 0"), new


SNAPSHOTS_SQL = """WITH a AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS priority FROM orders WHERE o_orderkey % 7 <> 0) """


@query(SNAPSHOTS_SQL + """SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'create' WHEN b.id IS NULL THEN 'delete' ELSE 'modify' END AS action, b.status, b.priority FROM a FULL JOIN b ON a.id = b.id
WHERE a.id IS NULL OR b.id IS NULL OR a.status IS DISTINCT FROM b.status OR a.priority IS DISTINCT FROM b.priority""")
def derive_change(spark, sf_dir):
    return entities.derive_change(*snapshots(spark, sf_dir))


@query(SNAPSHOTS_SQL + "SELECT * FROM b")
def apply_change(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    return entities.apply_change(old, entities.derive_change(old, new))


@query(with_views("change") + "SELECT id, version, action <> 'delete' AS visible FROM change")
def history_convert(spark, sf_dir):
    return entities.to_history(views.changes(spark, sf_dir)).select("id", "version", "visible")


# Relations and routing --------------------------------------------------------------------------


def applied(spark, sf_dir, rules: str) -> DataFrame:
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    relations = r.select(F.col("r_regionkey").alias("id"), F.create_map(F.lit("name"), "r_name", F.lit("type"), F.lit("boundary")).alias("tags"))
    members = n.select(F.col("n_regionkey").alias("relation"), F.col("n_nationkey").alias("member"), F.when(F.col("n_nationkey") % 2 == 0, "outer").otherwise("inner").alias("role"))
    nations = n.select(F.col("n_nationkey").alias("id"), F.create_map(F.lit("name"), "n_name").alias("tags"))
    return graphs.write_tags(nations, graphs.apply_to_members(relations, members, nations, parse_rules(rules)))


@query("SELECT n_nationkey AS id, n_name || '/' || r_name AS path, coalesce(CASE WHEN r_name = 'ASIA' THEN 'east' END, 'any') AS side FROM nation JOIN region ON r_regionkey = n_regionkey")
def relation_apply(spark, sf_dir):
    rules = "type = boundary { apply { set path = '$(name)/${name}'; add name = never } }\nname = ASIA { apply { set side = east } }\ntype = * { apply { add side = any } }"
    return applied(spark, sf_dir, rules).select("id", *[F.element_at("tags", F.lit(k)).alias(k) for k in ("path", "side")])


@query("SELECT n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN r_name END AS ring FROM nation JOIN region ON r_regionkey = n_regionkey")
def relation_apply_role(spark, sf_dir):
    got = applied(spark, sf_dir, "type = boundary { apply role=outer { set ring = '${name}' } }")
    return got.select("id", F.element_at("tags", F.lit("ring")).alias("ring"))


@query(with_views("member", recursive=True) + ", d AS (SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS member, 0 AS depth FROM region UNION SELECT d.root, m.member, d.depth + 1 FROM d JOIN member m ON m.relation = d.member) SELECT * FROM d WHERE depth > 0")
def relation_recursive(spark, sf_dir):
    roots = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"))
    return graphs.descendants(views.members(spark, sf_dir), roots)


def some_customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 50 = 3").select(F.lit("N").alias("member_type"), F.concat(F.lit("c"), "c_custkey").alias("member"))


@query("WITH n AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_custkey % 50 = 3) SELECT 'n' || k AS relation FROM n UNION ALL SELECT DISTINCT 'r' || n_regionkey FROM nation JOIN n ON k = n_nationkey")
def cascading_relations(spark, sf_dir):
    return entities.clip_relations(views.members(spark, sf_dir), some_customers(spark, sf_dir), cascading=True)


@query(with_views("member") + "SELECT member_type, member FROM member WHERE relation = 'r1' UNION ALL SELECT m.member_type, m.member FROM member m JOIN member r ON r.relation = 'r1' AND r.member = m.relation")
def complete_relations(spark, sf_dir):
    return entities.complete_relations(views.members(spark, sf_dir), spark.createDataFrame([("r1",)], "relation string"))


@query(with_views("member") + "SELECT relation, member, role FROM member WHERE member_type = 'N' AND member[1] = 'c' AND substr(member, 2)::BIGINT % 50 = 3")
def clip_incomplete_entities(spark, sf_dir):
    return entities.clip_incomplete(views.members(spark, sf_dir), some_customers(spark, sf_dir)).select("relation", "member", "role")


@query("""WITH t AS (SELECT DISTINCT n_regionkey AS root, c_custkey % 64 AS tile_id FROM customer JOIN nation ON n_nationkey = c_nationkey),
m AS (SELECT n_regionkey AS root, 'n' || n_nationkey AS member FROM nation UNION ALL SELECT n_regionkey, 'c' || c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT n_regionkey, 's' || s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT member, tile_id FROM m JOIN t USING (root)""")
def keep_complete_closure(spark, sf_dir):
    tiles = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("member"), (F.col("c_custkey") % 64).alias("tile_id"))
    return partition.complete_tiles(views.members(spark, sf_dir), table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id")), tiles)


@query(with_views("node") + """, a AS (SELECT n_name AS area, ((n_nationkey * 104729) % 3401 - 1700) * 1000000 + 500 AS cx, ((n_nationkey * 7919) % 1601 - 800) * 1000000 AS cy FROM nation)
SELECT id, area FROM node JOIN a ON abs(lon_e7 - cx) + abs(lat_e7 - cy) < 90000000""")
def bounds_containment(spark, sf_dir):
    x = ((F.col("n_nationkey") * 104729) % 3401 - 1700) * 1_000_000 + 500
    y = ((F.col("n_nationkey") * 7919) % 1601 - 800) * 1_000_000
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    r = 90_000_000
    areas = table(spark, sf_dir, "nation").select(F.col("n_name").alias("area"), F.array(corner(r, 0), corner(0, r), corner(-r, 0), corner(0, -r), corner(r, 0)).alias("ring"))
    return entities.contained(views.nodes(spark, sf_dir), areas, "id", "area")


@query(with_views("way_node") + "SELECT way_id, seq, node_id AS a, b FROM (SELECT *, lead(node_id) OVER (PARTITION BY way_id ORDER BY seq) AS b FROM way_node) WHERE b IS NOT NULL")
def routing_edges(spark, sf_dir):
    return graphs.routing_edges(views.way_nodes(spark, sf_dir))


@query("SELECT event_id, (floor((epoch_us(ts) + (event_id * 7919 % 90000) * 1000000) / 21600000000) + 1)::BIGINT AS sequence FROM events WHERE event_type <> 'signup'")
def transaction_deltas(spark, sf_dir):
    """Events as transactions that last up to 25 hours, sent in deltas of six hours; those of sign-ups never end."""
    moment = lambda s: F.floor((F.unix_micros(F.col("ts").cast("timestamp")) + s * 1_000_000) / 21_600_000_000) + 1
    log = table(spark, sf_dir, "events").select("event_id", moment(F.lit(0)).alias("began"), F.when(F.col("event_type") != "signup", moment(F.col("event_id") * 7919 % 90000)).alias("ended"))
    folder = f"{shared_folder(spark)}/terrane-transactions-{uuid.uuid4().hex}"
    transactions.snapshots_of(log, "event_id", "began", "ended").write.parquet(f"{folder}/snapshots")
    return transactions.replicate(spark, log.select("event_id"), f"{folder}/snapshots", f"{folder}/deltas", f"{folder}/state", "event_id")


FLARE_SQL = with_views("way", "way_node") + """, step AS (SELECT user_id AS roundabout, way_id AS arm, seq AS pos, node_id % 40 AS node, (node_id % 40) * 37 % 301 - 150 AS x, (node_id % 40) * 53 % 301 - 150 AS y FROM way_node JOIN way ON id = way_id),
  walked AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(pos) OVER w IS NOT NULL AS extends FROM step WINDOW w AS (PARTITION BY roundabout, arm ORDER BY pos)),
  summed AS (SELECT *, sum(coalesce(sqrt((x - px) ** 2 + (y - py) ** 2), 0)) OVER (PARTITION BY roundabout, arm ORDER BY pos) AS length FROM walked),
  met AS (SELECT * FROM summed WHERE pos > 1 QUALIFY row_number() OVER (PARTITION BY roundabout, node, arm ORDER BY pos) = 1),
  firsts AS (SELECT roundabout, arm, max(x) FILTER (pos = 1) AS ex, max(y) FILTER (pos = 1) AS ey, max(x) FILTER (pos = 2) AS fx, max(y) FILTER (pos = 2) AS fy FROM step GROUP BY ALL),
  shared AS (SELECT met.*, ex, ey, fx, fy, priority AS name, status AS access, round(degrees(atan2(ey::DOUBLE, ex::DOUBLE)), 6) AS around, count(*) OVER (PARTITION BY met.roundabout, node) AS n FROM met JOIN firsts USING (roundabout, arm) JOIN way ON id = arm),
  placed AS (SELECT *, row_number() OVER (PARTITION BY roundabout, node ORDER BY around, arm) AS k FROM shared WHERE n > 1),
  pair AS (SELECT a.roundabout, a.node, a.n, least(a.arm, b.arm) AS arm_a, greatest(a.arm, b.arm) AS arm_b FROM placed a JOIN placed b ON a.roundabout = b.roundabout AND a.node = b.node AND b.k = a.k % a.n + 1),
  twins AS (SELECT DISTINCT p.*, a AS a, b AS b FROM pair p JOIN placed a ON a.roundabout = p.roundabout AND a.node = p.node AND a.arm = arm_a JOIN placed b ON b.roundabout = p.roundabout AND b.node = p.node AND b.arm = arm_b),
  best AS (SELECT * FROM twins QUALIFY row_number() OVER (PARTITION BY roundabout, arm_a, arm_b ORDER BY round(a.length + b.length, 6), node) = 1),
  told AS (SELECT roundabout, arm_a, arm_b, node, n, a, b, round(a.length, 6) AS length_a, round(b.length, 6) AS length_b, round(sqrt((a.ex - b.ex) ** 2 + (a.ey - b.ey) ** 2), 6) AS separation,
    degrees(atan2((a.py - a.y)::DOUBLE, (a.px - a.x)::DOUBLE)) - degrees(atan2((b.py - b.y)::DOUBLE, (b.px - b.x)::DOUBLE)) AS d1, degrees(atan2((a.fy - a.ey)::DOUBLE, (a.fx - a.ex)::DOUBLE)) - degrees(atan2((b.fy - b.ey)::DOUBLE, (b.fx - b.ex)::DOUBLE)) AS d2, a.around - b.around AS d3 FROM best),
  angled AS (SELECT *, round(least(abs(d1), 360 - abs(d1)), 6) AS angle, round(least(abs(d2), 360 - abs(d2)), 6) AS bearing, round(least(abs(d3), 360 - abs(d3)), 6) AS entry_angle FROM told),
  judged AS (SELECT *, greatest(length_a, length_b) <= 200 AS ok_length, greatest(length_a, length_b) <= 3 * least(length_a, length_b) AS ok_multiple, greatest(length_a, length_b) <= 7 * greatest(separation, 5) AS ok_separation, angle <= 90 AS ok_angle, bearing <= 90 AS ok_bearing, entry_angle <= 145 AS ok_entry,
    NOT (a.extends AND b.extends) AS ok_extend, n = 2 AS ok_single, a.name = b.name AS ok_name, a.access = b.access AS ok_access FROM angled)
  SELECT roundabout, arm_a, arm_b, node, round(length_a, 3) AS length_a, round(length_b, 3) AS length_b, round(separation, 3) AS separation, round(angle, 3) AS angle, round(bearing, 3) AS bearing, round(entry_angle, 3) AS entry_angle, ok_length, ok_multiple, ok_separation, ok_angle, ok_bearing, ok_entry, ok_extend, ok_single, ok_name, ok_access,
    ok_length AND ok_multiple AND ok_separation AND ok_angle AND ok_bearing AND ok_entry AND ok_extend AND ok_single AND ok_name AND ok_access AS flare FROM judged"""


@query(FLARE_SQL)
def roundabout_flares(spark, sf_dir):
    """Orders of a customer as roads from a roundabout at the origin, over nodes in metres; where they meet and what each rule says."""
    node = F.col("node_id") % 40
    ways = views.ways(spark, sf_dir)
    steps = views.way_nodes(spark, sf_dir).join(ways.select(F.col("id").alias("way_id"), F.col("user_id").alias("roundabout")), "way_id")
    steps = steps.select("roundabout", F.col("way_id").alias("arm"), F.col("seq").alias("pos"), node.alias("node"), (node * 37 % 301 - 150).alias("x"), (node * 53 % 301 - 150).alias("y"))
    centres = ways.select(F.col("user_id").alias("roundabout"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy")).distinct()
    arms = ways.select(F.col("id").alias("arm"), F.col("tags")["priority"].alias("name"), F.col("tags")["status"].alias("access"))
    found = roundabouts.flares(steps, centres, arms)
    return found.withColumns({c: F.round(c, 3) for c in ("length_a", "length_b", "separation", "angle", "bearing", "entry_angle")})


@query()
def islands(spark, sf_dir):
    return graphs.islands(graphs.routing_edges(views.way_nodes(spark, sf_dir)).select("a", "b"))  # all pairs of a part are too many for recursive SQL; a test has union-find


@query("SELECT a.c_custkey AS id, min(b.s_suppkey) AS nearest FROM customer a JOIN supplier b ON b.s_nationkey = a.c_nationkey JOIN (SELECT c_custkey, min(abs(c_acctbal - s_acctbal)) AS d FROM customer JOIN supplier ON s_nationkey = c_nationkey GROUP BY 1) m ON m.c_custkey = a.c_custkey AND abs(a.c_acctbal - b.s_acctbal) = m.d GROUP BY 1")
def housenumber_nearest(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("street"), F.col("c_acctbal").alias("x"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("road"), F.col("s_nationkey").alias("street"), F.col("s_acctbal").alias("y"))
    return graphs.nearest_along(c, s.withColumnRenamed("y", "x"), "street", "x", "road").select("id", F.col("road").alias("nearest"))


@query(with_views("node") + "SELECT id FROM node a WHERE NOT EXISTS (SELECT 1 FROM node b WHERE b.ptype = a.ptype AND b.id < a.id AND abs(a.lat_e7 - b.lat_e7) <= 60000000 AND abs(a.lon_e7 - b.lon_e7) <= 60000000)")
def nearby_poi_dedup(spark, sf_dir):
    n = views.nodes(spark, sf_dir).withColumn("ptype", F.element_at("tags", F.lit("ptype")))
    return graphs.nearby_duplicates(n, "ptype", 60_000_000).select("id")


@query("SELECT p_partkey AS id, (row_number() OVER (ORDER BY p_size DESC, p_partkey))::INTEGER AS rank FROM part")
def order_by_area(spark, sf_dir):
    return partition.largest_first(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size")), "size", "id").select("id", "rank")


@query("SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS word, p_partkey AS id FROM part")
def name_index(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return graphs.name_index(part, "name", "id").select("word", "id")


@query(with_views("way_node") + "SELECT way_id, min(p_type) AS barrier FROM way_node JOIN part ON p_partkey = node_id WHERE p_size > 45 GROUP BY way_id")
def link_pois(spark, sf_dir):
    poi = table(spark, sf_dir, "part").where("p_size > 45").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("barrier"))
    return graphs.link_points_to_ways(views.way_nodes(spark, sf_dir), poi, "barrier")


@query("SELECT doc_id, regexp_replace(replace(replace(replace(text, 'é', 'e'), 'ß', 'ss'), 'ñ', 'n'), '[^\\x00-\\x7F]', '?', 'g') AS ascii FROM documents".replace("\\\\", "\\"))
def transliterate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", strings.transliterate(F.col("text"), {"é": "e", "ß": "ss", "ñ": "n"}).alias("ascii"))


# Replication ------------------------------------------------------------------------------------------

BEGIN, END = datetime(2024, 1, 5), datetime(2024, 1, 12)


@query(with_views("change") + "SELECT id, version, action FROM change WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12'")
def interval_changes(spark, sf_dir):
    return replicate.interval(views.changes(spark, sf_dir), BEGIN, END).select("id", "version", "action")


@query("SELECT epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts)) AS lag_us FROM events")
def replication_lag(spark, sf_dir):
    return replicate.lag_seconds(views.changes(spark, sf_dir), datetime(2024, 2, 1))


@query(with_views("change") + "SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, id, version, action FROM change QUALIFY row_number() OVER (PARTITION BY day, id ORDER BY version DESC, ts DESC) = 1")
def merge_intervals(spark, sf_dir):
    got = replicate.merge_intervals(views.changes(spark, sf_dir), "1 day")
    return got.select(F.col("interval_start").cast("timestamp_ntz").alias("day"), "id", "version", "action")


@query(with_views("change") + f"SELECT id, version, k FROM (SELECT * FROM change QUALIFY {LAST}) WHERE action <> 'delete'")
def stream_apply(spark, sf_dir):
    """The change stream through files, Structured Streaming and the store, in several batches."""
    root = shared_folder(spark)
    changes = views.changes(spark, sf_dir).select("id", "version", "action", "ts", "k")
    path = f"{root}/terrane-stream-{uuid.uuid4().hex}"
    changes.repartitionByRange(6, "ts").write.parquet(f"{path}/in")
    store = replicate.Store(spark, f"{path}/store", "id long, version int, ts timestamp_ntz, k string")
    stream = replicate.read_changes(spark, f"{path}/in", changes.schema, most_files=2)
    alive = replicate.follow(stream, store, f"{path}/checkpoint")
    return alive.select("id", "version", "k")


# Coast and sea ---------------------------------------------------------------------------------------------

SEA_TILE = 100_000_000
#: Islands by a rule that SQL has too: a rectangle for each part, some with a lake, in squares of their own up to 500 000 parts.
ISLAND_SQL = """island AS (SELECT p_partkey AS k, p_size AS size, ((p_partkey * 7919) % 1000) * 3600000 - 1800000000 + 200000 AS x0, ((p_partkey * 7919) // 1000 % 500) * 3600000 - 900000000 + 200000 AS y0,
  600000 + p_size * 50000 AS w, 600000 + (p_partkey % 50) * 50000 AS h FROM part),
box AS (SELECT k, size, 0 AS lake, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM island UNION ALL
  SELECT k, size, 1, x0 + 200000, y0 + 200000, x0 + 400000, y0 + 400000 FROM island WHERE size > 25)"""


def coast_pieces(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Pieces (id, first_node, last_node) and their points: four sides of an island in scrambled order of ids, of a lake the other way round.

    Where size % 10 is 9 the last side of the island is missing, where it is 8 it ends 10 units before the first begins.
    """
    k, size = F.col("p_partkey"), F.col("p_size").cast("long")
    x0, y0 = (k * 7919 % 1000) * 3600000 - 1800000000 + 200000, F.expr("(p_partkey * 7919) div 1000 % 500") * 3600000 - 900000000 + 200000
    part = table(spark, sf_dir, "part").select(k.alias("k"), size.alias("size"), x0.alias("x0"), y0.alias("y0"), (x0 + 600000 + size * 50000).alias("x1"), (y0 + 600000 + k % 50 * 50000).alias("y1"))
    land = part.withColumn("lake", F.lit(0))
    lakes = part.where("size > 25").select("k", "size", (F.col("x0") + 200000).alias("x0"), (F.col("y0") + 200000).alias("y0"), (F.col("x0") + 400000).alias("x1"), (F.col("y0") + 400000).alias("y1"), F.lit(1).alias("lake"))
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")]

    def side(c: int, lake: bool) -> list:
        (xa, ya), (xb, yb) = (corners[-c], corners[-c - 1]) if lake else (corners[c], corners[(c + 1) % 4])
        end = F.lit((c + 1) % 4 + 4 * lake)
        short = (F.col("size") % 10 == 8) & F.lit(c == 3 and not lake)
        return [F.lit(4 * lake + c * 3 % 4).alias("o"), F.lit(4 * lake + c).alias("a"), F.when(short, 8).otherwise(end).alias("b"), F.lit(c).alias("c"),
                F.col(xa).alias("xa"), F.col(ya).alias("ya"), F.col(xb).alias("xb"), F.when(short, F.col(yb) + 10).otherwise(F.col(yb)).alias("yb")]

    sides = F.when(F.col("lake") == 1, F.array(*[F.struct(*side(c, True)) for c in range(4)])).otherwise(F.array(*[F.struct(*side(c, False)) for c in range(4)]))
    rows = land.unionByName(lakes).select("k", "size", "lake", F.explode(sides).alias("s")).where("NOT (size % 10 = 9 AND lake = 0 AND s.c = 3)")
    pieces = rows.select((F.col("k") * 16 + F.col("s.o")).alias("id"), (F.col("k") * 16 + F.col("s.a")).alias("first_node"), (F.col("k") * 16 + F.col("s.b")).alias("last_node"))
    ends = F.array(*[F.struct(F.lit(n).alias("seq"), F.col(f"s.x{e}").alias("lon_e7"), F.col(f"s.y{e}").alias("lat_e7")) for n, e in enumerate("ab")])
    return pieces, rows.select((F.col("k") * 16 + F.col("s.o")).alias("id"), F.explode(ends).alias("p")).select("id", "p.*")


@query(f"""WITH {ISLAND_SQL} SELECT k * 16 + lake * 4 + c * 3 % 4 AS id, k * 16 + lake * 4 AS ring, c AS position, lake = 1 OR size % 10 NOT IN (8, 9) AS closed,
  CASE WHEN lake = 1 THEN 'lake' WHEN size % 10 <> 9 THEN 'land' END AS kind FROM box, range(4) r(c) WHERE NOT (lake = 0 AND size % 10 = 9 AND c = 3)""")
def coast_rings(spark, sf_dir):
    """Every coastline piece with its ring, place and what the ring encloses (null where it stays open)."""
    pieces, points = coast_pieces(spark, sf_dir)
    members = sea.join_pieces(pieces)
    areas = sea.ring_areas(sea.coast_segments(members, points, gap_e7=10))
    return members.join(shuffled(areas.select("ring", "kind")), "ring", "left").select("id", "ring", "position", "closed", "kind")


@query(f"""WITH {ISLAND_SQL}, tile AS (SELECT c AS col, r AS row, c * {SEA_TILE} - 1800000000 AS l, r * {SEA_TILE} - 900000000 AS b FROM range(36) x(c), range(18) y(r)),
a AS (SELECT col, row, sum((1 - 2 * lake) * (least(x1, l + {SEA_TILE}) - greatest(x0, l)) * (least(y1, b + {SEA_TILE}) - greatest(y0, b))) AS area
  FROM box JOIN tile ON x0 < l + {SEA_TILE} AND x1 > l AND y0 < b + {SEA_TILE} AND y1 > b WHERE lake = 1 OR size % 10 <> 9 GROUP BY col, row)
SELECT col AS "column", row AS "row", (2 * coalesce(area, 0))::BIGINT AS double_land, CASE WHEN coalesce(area, 0) = 0 THEN 'sea' ELSE 'mixed' END AS kind FROM tile LEFT JOIN a USING (col, row)""")
def sea_land_tiles(spark, sf_dir):
    """Land of every tile of 10 degrees, from the coastline."""
    pieces, points = coast_pieces(spark, sf_dir)
    parts = sea.coast_segments(sea.join_pieces(pieces), points, gap_e7=10)
    return sea.sea_tiles(parts, SEA_TILE).select("column", "row", F.col("double_land").cast("long").alias("double_land"), "kind")


# Binary entity files ---------------------------------------------------------------------------------------

def through_pbf(entities: DataFrame, kind: str) -> DataFrame:
    """Entities written as binary files and read back from them, in splits of 1 MB."""
    path = f"{shared_folder(entities.sparkSession)}/terrane-pbf-{uuid.uuid4().hex}"
    pbf.write_pbf(entities, path, kind)
    return pbf.read_pbf(entities.sparkSession, path, kind, split_bytes=1 << 20)


@query(with_views("node") + "SELECT id, lat_e7, lon_e7, ptype, brand, pname, size::VARCHAR AS size FROM node")
def pbf_nodes(spark, sf_dir):
    back = through_pbf(views.nodes(spark, sf_dir), "node")
    return back.select("id", "lat_e7", "lon_e7", *[F.col("tags")[k].alias(k) for k in ("ptype", "brand", "pname", "size")])


@query(with_views("way", "way_node") + """SELECT id, user_id::INTEGER AS user_id, tstamp::TIMESTAMP AS tstamp, status, priority, nodes FROM way
JOIN (SELECT way_id, string_agg(node_id, ',' ORDER BY seq) AS nodes FROM way_node GROUP BY way_id) ON id = way_id""")
def pbf_ways(spark, sf_dir):
    """Ways with the ordered nodes of their lines."""
    lists = views.way_nodes(spark, sf_dir).groupBy(F.col("way_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("seq", "node_id")))["node_id"].alias("nodes"))
    back = through_pbf(views.ways(spark, sf_dir).join(lists, "id"), "way")
    return back.select("id", "user_id", F.col("tstamp").cast("timestamp_ntz").alias("tstamp"), F.col("tags")["status"].alias("status"), F.col("tags")["priority"].alias("priority"), F.array_join("nodes", ",").alias("nodes"))


@query("SELECT o_custkey AS id, count(*) AS n, string_agg('way' || o_orderkey || o_orderstatus, ',' ORDER BY o_orderkey) AS members FROM orders GROUP BY o_custkey")
def pbf_relations(spark, sf_dir):
    """A relation for each customer, its orders as members with the status as their role."""
    member = F.struct(F.lit("way").alias("type"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("role"))
    relations = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    shown = F.transform("members", lambda m: F.concat(m["type"], m["id"].cast("string"), m["role"]))
    return through_pbf(relations, "relation").select("id", F.size("members").cast("long").alias("n"), F.array_join(shown, ",").alias("members"))


EVENT_TAGS = "e AS (SELECT user_id AS id, event_type AS key, props->>'$.k' AS value, ts, event_id FROM events)"


def event_tags(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("key"), F.get_json_object("props", "$.k").alias("value"), "ts", "event_id")


@query(f"""WITH {EVENT_TAGS}, l AS (SELECT id, key, value FROM e QUALIFY row_number() OVER (PARTITION BY id, key ORDER BY ts DESC, event_id DESC) = 1)
SELECT id, string_agg(key || '=' || coalesce(value, ''), ',' ORDER BY key) AS tags FROM l GROUP BY id""")
def build_tags(spark, sf_dir):
    """Every user's tags folded from events in order of time, the last of a key winning."""
    maps = folds.fold_tags(event_tags(spark, sf_dir), ["id"], "key", "value", ["ts", "event_id"])
    shown = F.transform(F.map_entries("tags"), lambda t: F.concat(t["key"], F.lit("="), F.coalesce(t["value"], F.lit(""))))
    return maps.select("id", F.array_join(shown, ",").alias("tags"))


@query(f"WITH {EVENT_TAGS} SELECT id, key, value FROM e QUALIFY row_number() OVER (PARTITION BY id, key ORDER BY ts DESC, event_id DESC) = 1")
def unnest_tags(spark, sf_dir):
    """The folded maps as rows again."""
    return folds.unfold_tags(folds.fold_tags(event_tags(spark, sf_dir), ["id"], "key", "value", ["ts", "event_id"]), ["id"])


@query(f"""WITH {EVENT_TAGS} SELECT id, (list(value ORDER BY ts, event_id) FILTER (value IS NOT NULL))[1] AS value, (list(key ORDER BY ts, event_id) FILTER (key IS NOT NULL))[1] AS key FROM e GROUP BY id""")
def first_aggregate(spark, sf_dir):
    """The first value and the first type of each user's events, in order of time."""
    return folds.first_values(event_tags(spark, sf_dir), ["id"], ["value", "key"], ["ts", "event_id"])


@query(with_views("change") + """, b AS (SELECT *, event_id * 4 // (SELECT max(event_id) + 1 FROM change) AS part FROM change)
SELECT id, version, k FROM (SELECT * FROM b WHERE part IN (0, 2) QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC, ts DESC) = 1) WHERE action <> 'delete'""")
def store_snapshot(spark, sf_dir):
    """Four batches out of order, one of them twice, into the store; and the snapshot that the second one left."""
    changes = views.changes(spark, sf_dir)
    most = changes.agg(F.max("event_id")).first()[0] or 0
    parts = changes.withColumn("part", F.expr(f"event_id * 4 div {most + 1}")).select("id", "version", "action", "ts", "k", "part")
    store = replicate.Store(spark, f"{shared_folder(spark)}/terrane-store-{uuid.uuid4().hex}", "id long, version int, ts timestamp_ntz, k string")
    at = None
    for sequence in (2, 0, 2, 3, 1):
        store.apply(parts.where(F.col("part") == sequence).drop("part"), sequence)
        at = store.snapshots()[-1] if sequence == 0 else at
    return store.read(snapshot=at).select("id", "version", "k")


# Scalar library --------------------------------------------------------------------------------------------

def add(name: str, sql: str, columns: Callable[[], dict]) -> None:
    """A query of scalar functions over part; columns are made when it runs, as they need a session."""

    def run(spark, sf_dir):
        return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), *[c.alias(k) for k, c in columns().items()])

    QUERIES[name] = run
    ORACLES[name] = f"SELECT p_partkey AS id, {sql} FROM part"


add("str_case", "upper(p_name) AS u, lower(p_brand) AS l, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS s", lambda: dict(u=strings.str_case(F.col("p_name"), "U"), l=strings.str_case(F.col("p_brand"), "L"), s=strings.str_case(F.col("p_type"), "S")))
add("str_loc", "nullif(instr(p_name, 'l'), 0)::INTEGER - 1 AS a, nullif(instr(reverse(p_name), 'l'), 0)::INTEGER - 1 AS b", lambda: dict(a=strings.str_loc(F.col("p_name"), "l"), b=strings.str_loc(F.col("p_name"), "l", True)))
add("str_rep", "replace(p_name, 'l', 'LL') AS v", lambda: dict(v=strings.str_rep(F.col("p_name"), "l", "LL")))
add("str_sort", "array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS v", lambda: dict(v=strings.str_sort(F.col("p_name"), " ")))
add("str_str", "CASE WHEN instr(p_name, ' ') > 0 THEN substr(p_name, instr(p_name, ' ')) END AS v", lambda: dict(v=strings.str_str(F.col("p_name"), " ")))
add("str_tok", "string_split(p_brand, '#')[1] AS a, string_split(p_brand, '#')[2] AS b, NULL::VARCHAR AS c", lambda: dict(a=strings.str_tok(F.col("p_brand"), "#", 0), b=strings.str_tok(F.col("p_brand"), "#", -1), c=strings.str_tok(F.col("p_brand"), "#", 5)))
add("word_find", "string_split(p_name, ' ')[-1] AS a, len(string_split(p_name, ' '))::VARCHAR AS n, p_name AS beyond", lambda: dict(a=words.word_find(F.col("p_name"), " ", "-1"), n=words.word_find(F.col("p_name"), " ", "#"), beyond=words.word_find(F.col("p_name"), " ", "+9")))
add("word_replace", "replace(p_name, 'e', 'E') AS a, regexp_replace(p_name, 'l', '_') AS b", lambda: dict(a=words.word_replace(F.col("p_name"), "e", "E"), b=words.word_replace(F.col("p_name"), "l", "_", "+1")))
add("word_add", "CASE WHEN split_part(p_name, ' ', 2) = 'bolt' THEN p_name ELSE p_name || ' bolt' END AS a", lambda: dict(a=words.word_add(F.col("p_name"), " ", "bolt")))
add("word_insert", "split_part(p_name, ' ', 1) || ' new ' || split_part(p_name, ' ', 2) AS v", lambda: dict(v=words.word_insert(F.col("p_name"), " ", "new", 2)))
add("str_filter", "regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits, upper(regexp_replace(p_name, '[aeiou]', '', 'g')) AS consonants", lambda: dict(digits=words.str_filter(F.col("p_brand"), keep="0-9"), consonants=words.str_filter(F.col("p_name"), drop="aeiou", upper=True)))
add("version_compare", "CASE WHEN p_size % 10 = 5 THEN CASE WHEN p_size < 10 THEN 0 ELSE 1 END WHEN p_size // 10 > 0 OR p_size % 10 > 5 THEN 1 ELSE 2 END AS v", lambda: dict(v=words.version_compare(F.concat((F.col("p_size") / 10).cast("int").cast("string"), F.lit("."), (F.col("p_size") % 10).cast("string")), F.lit("0.5.0"))))
add("math_functions", "round(sin(p_size), 6) AS s, round(exp(p_size / 50), 6) AS e, round(atan2(p_size, 7), 6) AS t, p_size % 7 AS m", lambda: dict(s=F.round(maths.UNARY["sin"](F.col("p_size")), 6), e=F.round(maths.UNARY["exp"](F.col("p_size") / 50), 6), t=F.round(maths.BINARY["atan2"](F.col("p_size"), F.lit(7)), 6), m=maths.BINARY["fmod"](F.col("p_size"), F.lit(7))))
add("unsigned_compare", "CASE WHEN p_size > 25 THEN true ELSE p_size < 25 - p_size END AS less", lambda: dict(less=maths.unsigned_less(F.col("p_size").cast("long"), F.lit(25).cast("long") - F.col("p_size"))))


@query("SELECT doc_id, coalesce(len(string_split(text, chr(10))), -1)::INTEGER AS lines, string_split(text, chr(10))[1] AS first, string_split(text, chr(10))[-1] AS last FROM documents")
def text_lines(spark, sf_dir):
    d, t = table(spark, sf_dir, "documents"), F.col("text")
    return d.select("doc_id", texts.line_sum(t).alias("lines"), texts.line_read(t, 1).alias("first"), texts.line_read(t, -1).alias("last"))


@query("SELECT doc_id, n::INTEGER AS n, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n, len(string_split(text, chr(10))) AS k FROM documents) WHERE n BETWEEN 2 AND k - 1")
def text_line_find(spark, sf_dir):
    return texts.line_find(table(spark, sf_dir, "documents"), "text", "doc_id", 2, -2)


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name, regexp_extract(url, '^(.*)/[^/]*$', 1) AS parent FROM pages")
def path_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", texts.file_name(F.col("url")).alias("name"), texts.parent_path(F.col("url")).alias("parent"))


@query("SELECT page_id, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title FROM pages")
def word_find_between(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.nullif(words.between(F.col("html"), "<title>", "</title>"), F.lit("")).alias("title"))
