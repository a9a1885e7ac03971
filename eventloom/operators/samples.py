"""Research samples: controls without events, and events with the features known at their time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sign_flag(x):
    """True above zero, false otherwise, null for null."""
    return x > 0


def control_samples(features: DataFrame, labels: DataFrame, links: DataFrame, per_day: int = 100, min_score: float = 0.35) -> DataFrame:
    """The entities of each day with the most turnover that no scored link touches on that day.

    features (entity, day, turnover, ...), labels (entity, day, forward_*),
    links (entity, day, score).  Rank limits are pushed below the shuffle.
    """
    linked = links.filter(F.col("score") >= min_score).select("entity", "day").distinct()
    free = features.join(linked, ["entity", "day"], "left_anti").join(labels, ["entity", "day"], "left")
    rank = F.row_number().over(Window.partitionBy("day").orderBy(F.desc_nulls_last("turnover"), "entity"))
    flags = {f"up_{c.split('_')[-1]}": sign_flag(F.col(c)) for c in labels.columns if c.startswith("forward_")}
    return free.withColumn("control_rank", rank).filter(F.col("control_rank") <= per_day).withColumns(flags)


def as_of(events: DataFrame, features: DataFrame, event_day: str = "event_date", feature_day: str = "day", **more: DataFrame) -> DataFrame:
    """Events (with entity) with ``f``: the entity's latest feature row at or before the event's day, or null.

    One sort by entity over the union of all sides; no event is joined to more than one row.
    ``more`` are other tables like the features, each with a column of its name; what
    the columns entity and day of a row say stands outside of it and is sent once.
    """
    tables = {"f": features, **more}
    kept = {n: [c for c in t.columns if c != "entity"] for n, t in tables.items()}
    row = {n: F.struct(*cs) for n, cs in kept.items()}
    own = [c for c in events.columns if c not in ("entity", event_day)]
    e = events.select("entity", F.col(event_day).alias("at"), F.lit(1).alias("kind"), F.struct(*own).alias("e"))
    both = e
    for n, t in tables.items():
        both = both.unionByName(t.select("entity", F.col(feature_day).alias("at"), F.lit(0).alias("kind"), row[n].alias(n)), allowMissingColumns=True)
    order = Window.partitionBy("entity").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({n: F.last(n, ignorenulls=True).over(order) for n in tables}).filter("kind = 1")
    whole = {n: F.when(F.col(n).isNotNull(), F.struct(*[(F.col("entity") if c == "entity" else F.col(n)[c]).alias(c) for c in t.columns])).alias(n) for n, t in tables.items()}
    back = {"entity": F.col("entity"), event_day: F.col("at").alias(event_day)}
    return found.select(*[back.get(c, F.col("e")[c].alias(c)) for c in events.columns], *whole.values())


def impact_level(score):
    """S, A, B or C by the link score."""
    return F.when(score >= 0.8, "S").when(score >= 0.6, "A").when(score >= 0.4, "B").otherwise("C")


def event_samples(links: DataFrame, features: DataFrame, labels: DataFrame, min_score: float = 0.35) -> DataFrame:
    """One row for each (event, entity): rank in its event, breadth of the event, as-of features, forward labels.

    links (event_id, entity, event_date, score, group).  Of several links of
    a pair the lowest score stays, as rows are written by falling score and
    later ones replace earlier ones; of equal scores the same row at every run.
    labels (entity, day, ...) have one row for an entity and a day.
    """
    scored = links.filter(F.col("score") >= min_score)
    last = Window.partitionBy("event_id", "entity").orderBy(F.asc("score"), F.xxhash64(*scored.columns))
    # breadth: the first rows of an event's entities and groups are counted, so links are read and dealt out once
    first = scored.withColumns({"_n": F.row_number().over(last), "_g": F.row_number().over(Window.partitionBy("event_id", "group").orderBy("group"))})
    event = Window.partitionBy("event_id")
    counted = {"affected_entities": F.count(F.when(F.col("_n") == 1, F.col("entity"))).over(event), "affected_groups": F.count(F.when((F.col("_g") == 1) & (F.col("group") != ""), 1)).over(event)}
    one = first.withColumns(counted).filter("_n = 1").drop("_n", "_g")
    rank = F.row_number().over(Window.partitionBy("event_id").orderBy(F.desc("score"), "entity"))
    base = one.withColumn("relation_rank", rank)
    known = as_of(base, features, label=labels)  # a label is that of its day, so the latest one will do
    on_day = (F.col("label.day") == F.col("event_date")) & F.col("entity").isNotNull()
    out = known.select("*", *[F.when(on_day, F.col("label")[c]).alias(c) for c in labels.columns if c not in ("entity", "day")]).drop("label")
    return out.withColumns({"impact_level": impact_level(F.col("score")), "feature_age_days": F.datediff("event_date", F.col("f.day"))})
