"""Entity views: the schemas of the engine, and their projections of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Envelopes of the entity tables, as DDL.
NODES = "id long, version int, user_id int, tstamp timestamp_ntz, changeset_id long, tags map<string,string>, lat double, lon double"
WAYS = "id long, version int, user_id int, tstamp timestamp_ntz, changeset_id long, tags map<string,string>, nodes array<long>"
RELATIONS = "id long, version int, user_id int, tstamp timestamp_ntz, changeset_id long, tags map<string,string>, members array<struct<type:string,id:long,role:string,seq:int>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def e7(value: str, factor: int, span: int, half: int):
    return ((F.col(value) * factor) % span - half) * 1000


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    tags = F.create_map(F.lit("ptype"), "p_type", F.lit("brand"), "p_brand", F.lit("pname"), "p_name", F.lit("size"), F.col("p_size").cast("string"))
    return part.select(F.col("p_partkey").alias("id"), e7("p_partkey", 7919, 1800001, 900000).alias("lat_e7"), e7("p_partkey", 104729, 3600001, 1800000).alias("lon_e7"), tags.alias("tags"))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    tags = F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority")
    return orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("tstamp"), tags.alias("tags"), F.col("o_totalprice").alias("price"))


def way_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem has no key: the position is a row number over a full tie-break list."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    lines = table(spark, sf_dir, "lineitem").withColumn("seq", F.row_number().over(order))
    return lines.select(F.col("l_orderkey").alias("way_id"), F.col("l_partkey").alias("node_id"), "seq")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region -> nation -> customer and supplier, as (relation, member_type, member_id, role); ids of relations are prefixed."""
    nation = table(spark, sf_dir, "nation")
    r = nation.select(F.concat(F.lit("r"), "n_regionkey").alias("relation"), F.lit("R").alias("member_type"), F.concat(F.lit("n"), "n_nationkey").alias("member"), F.lit("subarea").alias("role"))
    parts = [r]
    for name, key, fk in (("customer", "c_custkey", "c_nationkey"), ("supplier", "s_suppkey", "s_nationkey")):
        parts.append(table(spark, sf_dir, name).select(F.concat(F.lit("n"), fk).alias("relation"), F.lit("N").alias("member_type"), F.concat(F.lit(name[0]), key).alias("member"), F.lit(name).alias("role")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a change stream: id, version, action, ts, k (a tag out of the JSON props)."""
    version = Window.partitionBy("user_id").orderBy("ts", "event_id")
    action = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete").otherwise("modify")
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.row_number().over(version).alias("version"), action.alias("action"), "ts", k.alias("k"), "event_id")


# The same views for the SQL oracles.
SQL = {
    "node": "node AS (SELECT p_partkey AS id, ((p_partkey * 7919) % 1800001 - 900000) * 1000 AS lat_e7, ((p_partkey * 104729) % 3600001 - 1800000) * 1000 AS lon_e7, p_type AS ptype, p_brand AS brand, p_name AS pname, p_size AS size FROM part)",
    "way": "way AS (SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS tstamp, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price FROM orders)",
    "way_node": "way_node AS (SELECT l_orderkey AS way_id, l_partkey AS node_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate)::INTEGER AS seq FROM lineitem)",
    "member": "member AS (SELECT 'r' || n_regionkey AS relation, 'R' AS member_type, 'n' || n_nationkey AS member, 'subarea' AS role FROM nation UNION ALL SELECT 'n' || c_nationkey, 'N', 'c' || c_custkey, 'customer' FROM customer UNION ALL SELECT 'n' || s_nationkey, 'N', 's' || s_suppkey, 'supplier' FROM supplier)",
    "change": "change AS (SELECT user_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INTEGER AS version, CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'modify' END AS action, ts, props->>'$.k' AS k, event_id FROM events)",
}


def with_views(*names: str, recursive: bool = False) -> str:
    return "WITH " + "RECURSIVE " * recursive + ", ".join(SQL[n] for n in names) + " "
