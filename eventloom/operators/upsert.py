"""Keyed tables without MERGE: upserts, stale deletes, merges that keep what is filled, casts of text stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import fresh, written


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by ``order``; of equal ones the same at every run, by their values' hash."""
    return _one(rows, keys, F.desc(order))


def first_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order``; of equal ones the same at every run, by their values' hash."""
    return _one(rows, keys, F.asc(order))


def _one(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    n = fresh(rows, "n")
    hashed = [c for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    w = Window.partitionBy(*keys).orderBy(order, F.xxhash64(*hashed))
    return rows.withColumn(n, F.row_number().over(w)).filter(F.col(n) == 1).drop(n)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with rows of ``new`` in place of those with the same key, and its other rows added."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def without_stale(old: DataFrame, current: DataFrame, touched: list[str]) -> DataFrame:
    """``old`` without the rows of touched groups, then the current rows: stale ones of these groups go."""
    return old.join(current.select(*touched).distinct(), touched, "left_anti").unionByName(current)


def pending(rows: DataFrame, done: DataFrame, key: str, order: list[str], limit: int) -> DataFrame:
    """The first rows without a counterpart in ``done``: one micro-batch of open work."""
    return rows.join(done.select(key), key, "left_anti").orderBy(*order).limit(limit)


def filled_from(old: DataFrame, new: DataFrame, key: str, columns: list[str], empty: tuple[str, ...] = ("",), prefer: str = "new") -> DataFrame:
    """One row a key of both sides; each column from the preferred side unless null or an empty word there."""
    a, b = (old, new) if prefer == "old" else (new, old)
    out = [F.col(key)]
    for c in columns:
        filled = F.when(~F.col(f"a.{c}").isin(*empty), F.col(f"a.{c}"))
        out.append(F.coalesce(filled, F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c))
    return a.alias("a").join(b.alias("b"), key, "full").select(*out)


def content_updates(rows: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """``rows`` with new values of one column where ``updates`` has them."""
    new = updates.select(key, F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).select(*rows.columns)


def staged(rows: DataFrame, types: dict[str, str], defaults: dict[str, object]) -> DataFrame:
    """Text columns cast to their types; blanks and what can't be cast take the default."""
    return rows.select([F.coalesce(F.nullif(F.trim(c), F.lit("")).try_cast(types.get(c, "string")), F.lit(defaults.get(c))).alias(c) for c in rows.columns])


def numbered(rows: DataFrame, key: str, out: str) -> DataFrame:
    """``rows`` with their place, from 0, in the order of ``key``; nulls first, rows of equal keys in any order.

    The rows are sorted into ranges of the key and written once: the ranges'
    sizes and the rows' places then come from the same table, whatever columns
    a later plan reads.  No task sees more rows than a range has.
    """
    at, seq, n, first, before = (fresh(rows, x) for x in ("range", "seq", "n", "first", "before"))
    ranges = written(rows.repartitionByRange(key).sortWithinPartitions(key).withColumns({at: F.spark_partition_id(), seq: F.monotonically_increasing_id()}), "ranges")
    sizes = ranges.groupBy(at).agg(F.count(F.lit(1)).alias(n), F.min(seq).alias(first))  # a row for each range
    starts = sizes.withColumn(before, F.coalesce(F.sum(n).over(Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranges.join(F.broadcast(starts.drop(n)), at).withColumn(out, F.col(before) + F.col(seq) - F.col(first)).select(*rows.columns, out)


def sharded(rows: DataFrame, key: str, shards: int, shard: int) -> DataFrame:
    """Rows whose place in the order of ``key`` leaves ``shard`` modulo ``shards``."""
    place = fresh(rows, "place")
    return numbered(rows, key, place).filter(F.pmod(place, F.lit(shards)) == shard).drop(place)
