"""Queries on entity master data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import master
from . import bindings as b


def folded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders folded to customers: the first priority that isn't blank, all statuses."""
    o = b.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.when(F.pmod("o_orderkey", F.lit(3)) == 0, "").otherwise(F.col("o_orderpriority")).alias("priority"), F.array("o_orderstatus").alias("statuses"))
    found = master.folded(o, "o_custkey", "o_orderkey", ["priority"], ["statuses"])
    return found.select("o_custkey", "priority", F.array_join("statuses", ",").alias("statuses"), "records")


def preferred_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's order by status preference, then the latest."""
    o = b.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.struct("o_orderdate", "o_orderkey").alias("at"))
    found = master.latest_preferred(o, "o_custkey", ["P", "F"], "o_orderstatus", "at")
    return found.select("o_custkey", "o_orderkey", "o_orderstatus")


def supplier_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands that a supplier delivers, the first eight: memberships turned round."""
    l = b.table(spark, sf_dir, "lineitem").join(b.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))  # noqa: E741
    groups = l.groupBy("p_brand").agg(F.collect_set("l_suppkey").alias("members"))
    found = master.memberships(groups, "p_brand", "members")
    return found.select("member", F.array_join("groups", ",").alias("groups"))


QUERIES = {f.__name__: f for f in (folded_customers, preferred_order, supplier_memberships)}
ORACLE_SQL = {
    "folded_customers": """SELECT o_custkey, arg_min(p, CASE WHEN p IS NOT NULL THEN o_orderkey END) AS priority, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, count(*) AS records
FROM (SELECT *, CASE WHEN o_orderkey % 3 <> 0 AND trim(o_orderpriority) <> '' THEN o_orderpriority END AS p FROM orders) GROUP BY 1""",
    "preferred_order": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, o_orderdate DESC, o_orderkey DESC) = 1",
    "supplier_memberships": "SELECT l_suppkey AS member, string_agg(p_brand, ',' ORDER BY p_brand) AS groups FROM (SELECT * FROM (SELECT DISTINCT l_suppkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY p_brand) <= 8) GROUP BY 1",
}
