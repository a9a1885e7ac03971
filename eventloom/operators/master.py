"""Entity master data: folding records, latest by preference, tags, memberships, inferred attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_hit


def merged_tags(existing: Column, more: Column, cap: int = 12) -> Column:
    """Distinct tags of both lists in order, at most ``cap``: the size of a label field."""
    none = F.array().cast("array<string>")
    return F.slice(F.array_distinct(F.filter(F.concat(F.coalesce(existing, none), F.coalesce(more, none)), lambda x: F.trim(x) != "")), 1, cap)


def folded(records: DataFrame, key: str, order: str, single: list[str], tags: list[str]) -> DataFrame:
    """One row a key: the first value of each ``single`` column that isn't blank, the union of ``tags`` columns, by ``order``."""
    firsts = [F.min_by(F.when(F.trim(c) != "", F.col(c)), F.when(F.trim(c) != "", F.col(order))).alias(c) for c in single]
    unions = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in tags]
    return records.groupBy(key).agg(*firsts, *unions, F.count(F.lit(1)).alias("records"))


def latest_preferred(rows: DataFrame, key: str, preference: list[str], column: str, date: str) -> DataFrame:
    """One row a key: the best by a preference over ``column``'s values, then the latest by ``date``."""
    rank = F.coalesce(*[F.when(F.col(column) == v, i) for i, v in enumerate(preference)], F.lit(len(preference)))
    order = Window.partitionBy(key).orderBy(rank, F.desc(date), column)
    return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def memberships(groups: DataFrame, group: str, members: str, cap: int = 8) -> DataFrame:
    """(member, groups): group lists turned round, each member's groups in order, at most ``cap``: the size of a label field."""
    one = groups.select(F.explode(members).alias("member"), group).distinct()
    place = F.row_number().over(Window.partitionBy("member").orderBy(group))
    return one.withColumn("_n", place).filter(F.col("_n") <= cap).groupBy("member").agg(F.array_sort(F.collect_list(group)).alias("groups"))


def state_owned(profile: Column, holders: Column) -> Column:
    """Whether a profile or its holders name the state as owner."""
    return any_hit(F.concat_ws(" ", profile, holders), ("国资委", "国有资产", "国有独资", "财政部", "中央汇金", "国有控股"))


def with_industry(rows: DataFrame, updates: DataFrame, key: str, column: str = "industry") -> DataFrame:
    """``rows`` with an industry from ``updates`` where these have one, else their own."""
    new = updates.select(key, F.nullif(F.trim(column), F.lit("")).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).select(*rows.columns)
