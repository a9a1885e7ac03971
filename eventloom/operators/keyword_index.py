"""A keyword index: postings of character trigrams, lists met by count, candidates verified in the texts.

A text in which a keyword of three letters or more occurs in any case has all
trigrams of the keyword.  Of these the rarest few are looked up, so a frequent
one costs nothing; what they leave is tested with ``ilike``, as a scan would.
Keywords whose longest run without wildcards is shorter take the scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

#: Trigrams of a keyword that are looked up.
LOOKED_UP = 4
#: Shares of the keys into which a gram's list is dealt.
SHARES = 64


@dataclass
class KeywordIndex:
    """Postings (gram, key) in order, and how many texts have each gram."""

    postings: DataFrame
    counts: DataFrame
    columns: list[str]
    key: str


def _grams(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("(?s)(?=(...))"), F.lit(1)))


def build(docs: DataFrame, key: str, columns: list[str]) -> KeywordIndex:
    """Postings of all trigrams of the columns of ``docs``; null texts have none."""
    grams = F.array_distinct(F.transform(F.concat(*(_grams(F.col(c)) for c in columns)), lambda g: F.xxhash64(g)))
    rows = docs.select(F.col(key).alias("key"), F.explode(grams).alias("gram"))
    # by gram and a share of the keys: a frequent gram's list spreads over SHARES tasks; ranges would read all texts twice
    postings = written(rows.repartition("gram", F.pmod(F.xxhash64("key"), F.lit(SHARES))).sortWithinPartitions("gram", "key"), "postings")
    return KeywordIndex(postings, written(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "grams"), columns, key)


def candidates(index: KeywordIndex, keyword: str) -> DataFrame | None:
    """Keys of the texts that have the rarest trigrams of a keyword; None if it has no trigram."""
    spark = index.postings.sparkSession
    runs = [r for r in re.split(r"[%_\\]+", keyword) if len(r) >= 3]
    if not runs:
        return None
    asked = spark.createDataFrame([(r,) for r in runs], "r string").select(F.explode(_grams(F.col("r"))).alias("g")).select(F.xxhash64("g").alias("gram")).distinct()
    wanted = [r.gram for r in asked.collect()]  # of one keyword
    rare = index.counts.filter(F.col("gram").isin(*wanted)).orderBy("n", "gram").collect()
    if len(rare) < len(wanted):
        return index.postings.limit(0).select("key")
    use = [r.gram for r in rare[:LOOKED_UP]]
    return index.postings.filter(F.col("gram").isin(*use)).groupBy("key").agg(F.count_distinct("gram").alias("n")).filter(F.col("n") == len(use)).select("key")


def search(index: KeywordIndex, docs: DataFrame, keywords: list[str]) -> DataFrame:
    """Rows of ``docs`` with one of the keywords in one of the index's columns, in any case: those of a scan."""
    hit = F.lit(False)
    for k in keywords:
        for c in index.columns:
            hit = hit | F.col(c).ilike(f"%{k}%")
    found = [candidates(index, k) for k in keywords]
    if not found or any(c is None for c in found):
        return docs.filter(hit)
    keys = found[0]
    for more in found[1:]:
        keys = keys.unionByName(more)
    return docs.join(keys.select(F.col("key").alias(index.key)).distinct(), index.key, "left_semi").filter(hit)
