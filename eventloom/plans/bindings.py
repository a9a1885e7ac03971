"""The given tables in the roles that the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import money, rounded
from ..operators.tables import dealt, shared_folder, written  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series of suppliers (entity, day, amount, volume, close) from order lines."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("day"), money(F.col("l_extendedprice")).alias("a"), money(F.col("l_quantity")).alias("q"))
    daily = lines.groupBy("entity", "day").agg(F.sum("a").cast("double").alias("amount"), F.sum("q").cast("double").alias("volume"))
    return daily.withColumn("close", rounded(F.col("amount") / F.col("volume"), 4))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of all suppliers together, by the same columns."""
    lines = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"), money(F.col("l_extendedprice")).alias("a"), money(F.col("l_quantity")).alias("q"))
    daily = lines.groupBy("day").agg(F.sum("a").cast("double").alias("amount"), F.sum("q").cast("double").alias("volume"))
    return daily.select(F.lit(0).cast("long").alias("entity"), "day", "amount", "volume", rounded(F.col("amount") / F.col("volume"), 4).alias("close"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events, their suppliers as linked entities, quantity / 50 as score, the supplier's nation as group.

    Dealt out by event, so what groups by it needs no other shuffle and a task's share doesn't grow.
    """
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.to_date("o_orderdate").alias("event_date"))
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_suppkey").alias("entity"), (F.col("l_quantity") / 50).alias("score"))  # noqa: E741
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("group"))
    s = table(spark, sf_dir, "supplier").join(F.broadcast(n), "s_nationkey").select(F.col("s_suppkey").alias("entity"), "group")
    rows = l.count()  # from the files' footers
    return dealt(l.join(s, "entity"), "event_id", rows).join(dealt(o, "event_id", rows), "event_id").select("entity", "event_id", "score", "event_date", "group")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as reports: user as cluster, type as channel, hour as source, sign of the value around 50 as sentiment."""
    e = table(spark, sf_dir, "events")
    score = F.when(F.col("value") > 50, 1).when(F.col("value") < 50, -1).otherwise(0)
    return e.select((F.col("user_id") % 97).alias("cluster"), F.to_date("ts").alias("day"), F.col("event_type").alias("channel"), F.hour("ts").alias("source"), score.alias("score"), score.alias("sentiment"))


PRICES_SQL = """
px AS (SELECT entity, day, amount, volume, floor(amount / volume * 1e4 + 0.5) / 1e4 AS close FROM (
  SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS day, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume FROM lineitem GROUP BY 1, 2)),
mk AS (SELECT day, floor(amount / volume * 1e4 + 0.5) / 1e4 AS close FROM (
  SELECT CAST(l_shipdate AS DATE) AS day, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS volume FROM lineitem GROUP BY 1)),
ret AS (SELECT *, close / lag(close) OVER (PARTITION BY entity ORDER BY day) - 1 AS r FROM px),
mret AS (SELECT *, close / lag(close) OVER (ORDER BY day) - 1 AS m FROM mk)"""

LINKS_SQL = """
links AS (SELECT o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS event_date, l_suppkey AS entity, l_quantity / 50 AS score, n_name AS "group"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

REPORTS_SQL = """
rep AS (SELECT user_id % 97 AS cluster, CAST(ts AS DATE) AS day, event_type AS channel, hour(ts) AS source,
  CASE WHEN value > 50 THEN 1 WHEN value < 50 THEN -1 ELSE 0 END AS score FROM events)"""
