"""Statistics of event clusters kept by day, so that a batch changes only its days; distinct sources stay exact.

A state row is a cluster's day and bucket of sources: counts, and a bitmap of
the sources' numbers.  States merge by sums and by OR, in any order, so a count
of distinct sources never needs the events again.  Sources get numbers once, in
a dictionary that grows.

Edges: a null source is no medium; a null day is a day of its own for the
totals, but an event without a day gets no statistics, as it meets no day; an
empty batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rounded
from .tables import fresh
from .upsert import numbered

COUNTS = ("reports", "positive", "neutral", "negative")


def cluster_key(name: Column, subject: Column, industry: Column) -> Column:
    """Events with the same name (in any case, without white space), subject type and industry form a cluster."""
    text = [F.coalesce(c, F.lit("")) for c in (name, subject, industry)]
    return F.md5(F.concat_ws("|", F.regexp_replace(F.lower(text[0]), "\\s+", ""), *text[1:]).cast("binary"))


def with_new_sources(dictionary: DataFrame | None, events: DataFrame) -> DataFrame:
    """The dictionary (source, number) with the events' new sources after the known ones."""
    asked = events.filter("source IS NOT NULL").select("source").distinct()
    if dictionary is None:
        return numbered(asked, "source", "number")
    start = dictionary.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    new = numbered(asked.join(dictionary, "source", "left_anti"), "source", "number")
    return dictionary.unionByName(new.withColumn("number", F.col("number") + start))


def state(events: DataFrame, dictionary: DataFrame, sentiments: tuple[str, str, str]) -> DataFrame:
    """(cluster, day, bucket, reports, positive, neutral, negative, sources) of a batch of events (cluster, day, source, sentiment)."""
    rows = events.select("cluster", "day", "source", "sentiment").join(dictionary, "source", "left")
    bucket = F.coalesce(F.bitmap_bucket_number("number"), F.lit(0)).alias("bucket")
    counts = [F.count(F.lit(1)).alias("reports"), *(F.count_if(F.col("sentiment") == s).alias(c) for s, c in zip(sentiments, COUNTS[1:]))]
    # bits of a null number: none, as the aggregate passes nulls over
    return rows.groupBy("cluster", "day", bucket).agg(*counts, F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("sources"))


def merged(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Two states as one."""
    if old is None:
        return new
    return old.unionByName(new).groupBy("cluster", "day", "bucket").agg(*(F.sum(c).alias(c) for c in COUNTS), F.bitmap_or_agg("sources").alias("sources"))


def touched(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Clusters whose statistics a batch changes."""
    return state.join(batch.select("cluster").distinct(), "cluster", "left_semi")


def statistics(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by cluster: report_count, media_coverage_count, heat_duration_days; by cluster and day: heat_growth_rate, disagreement_score)."""
    days = state.groupBy("cluster", "day").agg(*(F.sum(c).alias(c) for c in COUNTS))
    totals = days.groupBy("cluster").agg(F.sum("reports").alias("report_count"), F.count_if(F.col("reports") > 0).alias("heat_duration_days"))
    buckets = state.groupBy("cluster", "bucket").agg(F.bitmap_or_agg("sources").alias("sources"))
    media = buckets.groupBy("cluster").agg(F.sum(F.bitmap_count("sources")).alias("media_coverage_count"))
    before = days.select("cluster", F.date_add("day", 1).alias("day"), F.col("reports").alias("before"))
    daily = days.filter("day IS NOT NULL").join(before, ["cluster", "day"], "left")
    growth = (F.col("reports") - F.col("before")) / (F.col("before") + 1)
    entropy = F.lit(0.0)
    for c in COUNTS[1:]:
        share = F.col(c) / F.col("reports")
        entropy = entropy - F.when(F.col(c) > 0, share * F.log(share)).otherwise(0.0)
    away = F.signum(growth) * rounded(F.abs(growth), 6)  # halves go away from zero
    return totals.join(media, "cluster"), daily.select("cluster", "day", F.coalesce(away, F.lit(0.0)).alias("heat_growth_rate"), rounded(entropy, 6).alias("disagreement_score"))


def refreshed(events: DataFrame, state: DataFrame) -> DataFrame:
    """``events`` (cluster, day, ...) with the five columns of their cluster and day; those without a day keep what they have."""
    columns = ["report_count", "media_coverage_count", "heat_duration_days", "heat_growth_rate", "disagreement_score"]
    totals, daily = statistics(state)
    new = daily.join(totals, "cluster").withColumnsRenamed({c: fresh(events, f"new_{c}") for c in columns})
    joined = events.join(new, ["cluster", "day"], "left")
    kept = {c: F.coalesce(F.col(fresh(events, f"new_{c}")), F.col(c)) if c in events.columns else F.col(fresh(events, f"new_{c}")) for c in columns}
    return joined.select(*(c for c in events.columns if c not in columns), *(v.alias(c) for c, v in kept.items()))
