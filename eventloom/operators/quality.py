"""Coverage, fill and consistency reports; each check is a row (area, metric, value, total, status)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status(ratio: Column, ok: float, warn: float) -> Column:
    """OK, WARN or BLOCK by two thresholds; BLOCK for null."""
    return F.when(ratio >= ok, "OK").when(ratio >= warn, "WARN").otherwise("BLOCK")


def filled(c: str) -> Column:
    """Whether a value is neither null nor blank."""
    return F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))


def fill_report(df: DataFrame, area: str, ok: float = 0.95, warn: float = 0.8) -> DataFrame:
    """(area, metric, value, total, status): how many values of each column are filled, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(filled(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"c{i}").alias("value")) for i, c in enumerate(df.columns)]))
    out = counts.select("total", rows.alias("x")).select(F.lit(area).alias("area"), "x.metric", "x.value", "total")
    return out.withColumn("status", status(F.when(F.col("total") > 0, F.col("value") / F.col("total")), ok, warn))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of several tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def dictionary_misses(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """(column, rows): values that a dictionary (label) lacks."""
    known = dictionary.select(F.col("label").alias(column))
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows")).join(known, column, "left_anti")


def source_overview(df: DataFrame, source: str, good: Column) -> DataFrame:
    """One row: rows, good rows, sources, and quartiles of rows by source."""
    by = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.count_if(good).alias("g"))
    return by.agg(
        F.sum("n").alias("rows"), F.sum("g").alias("good_rows"), F.count(F.lit(1)).alias("sources"), F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
        F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY n)").alias("median_rows"), F.expr("percentile_cont(0.75) WITHIN GROUP (ORDER BY n)").alias("p75_rows"),
    )


def profile_progress(df: DataFrame, source: str, profiles: list[tuple[str, list[str], int]], good: Column) -> DataFrame:
    """(profile, rows, good_rows, target, gap): rows whose source is like one of a profile's patterns, in one pass.

    The first profile that fits takes a row.
    """
    name = F.coalesce(*[F.when(reduce(lambda a, b: a | b, [F.col(source).like(p) for p in patterns]), F.lit(n)) for n, patterns, _ in profiles], F.lit("other"))
    target = F.coalesce(*[F.when(F.col("profile") == n, t) for n, _, t in profiles], F.lit(0))
    out = df.groupBy(name.alias("profile")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("good_rows"))
    return out.withColumn("target", target.cast("long")).withColumn("gap", F.greatest(F.col("target") - F.col("good_rows"), F.lit(0)))


def good_body(title: Column, content: Column, least: int) -> Column:
    """Long enough, not the title, and not the title with little more."""
    t, c = F.trim(title), F.trim(content)
    return (F.length(c) >= least) & (c != t) & ~(c.startswith(t) & (F.length(c) <= F.length(t) + 40))


def label_stability(df: DataFrame, ref: str, labels: list[str]) -> DataFrame:
    """One row: refs, and those whose rows all have one combination of labels."""
    by = df.groupBy(ref).agg(F.countDistinct(F.struct(*labels)).alias("k"))
    return by.agg(F.count(F.lit(1)).alias("refs"), F.count_if(F.col("k") == 1).alias("stable"))


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, violations): rows for which each condition doesn't hold, in one pass."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("violations")) for k in checks])).alias("x")).select("x.*")


def year_rollup(df: DataFrame, day: Column, good: Column) -> DataFrame:
    """(year, rows, good_rows, pct)."""
    out = df.groupBy(F.year(day).alias("year")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(good).alias("good_rows"))
    return out.withColumn("pct", F.round(F.col("good_rows") * 100 / F.col("rows"), 2))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows without replacement, by a hash of the key and the seed: the same at every run."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


# -- delivery checks: each is (area, metric, value, target, status)


def presence(tables: dict[str, DataFrame | None], least: dict[str, int]) -> DataFrame:
    """A row for each table: its rows against the least wanted; a missing table (None) blocks."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    there = {k: df for k, df in tables.items() if df is not None}
    wanted = F.create_map(*[F.lit(x) for k in tables for x in (k, least.get(k, 1))])
    rows = table_counts(there).select(F.col("name").alias("area"), F.lit("row_count").alias("metric"), F.col("rows").cast("double").alias("value"), F.element_at(wanted, F.col("name")).cast("double").alias("target"))
    rows = rows.withColumn("status", F.when(F.col("value") >= F.col("target"), "OK").otherwise("BLOCK"))
    missing = [(k, "table_presence", None, float(least.get(k, 1)), "BLOCK") for k, df in tables.items() if df is None]
    return rows.unionByName(spark.createDataFrame(missing, "area string, metric string, value double, target double, status string")) if missing else rows


def required_tables(spark, names: list[str]) -> list[str]:
    """The names that the catalog lacks."""
    return [n for n in names if not spark.catalog.tableExists(n)]


def checks(df: DataFrame, area: str, ratios: dict[str, tuple[Column, float, float]] | None = None, counts: dict[str, tuple[Column, float, str]] | None = None) -> DataFrame:
    """Delivery checks of one table in one pass.

    ``ratios``: metric to (condition of a row, ok, warn): the share of rows that
    hold it.  ``counts``: metric to (aggregate, bound, kind): kind ``least``
    warns below the bound, ``most`` warns above it, ``blocks`` blocks below it.
    """
    ratios, counts = ratios or {}, counts or {}
    aggs = [F.count_if(F.coalesce(c, F.lit(False))).cast("double").alias(f"r{i}") for i, (c, _, _) in enumerate(ratios.values())] + [a.cast("double").alias(f"c{i}") for i, (a, _, _) in enumerate(counts.values())]
    one = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = []
    for i, (metric, (_, ok, warn)) in enumerate(ratios.items()):
        share = F.when(F.col("n") > 0, F.col(f"r{i}") / F.col("n")).otherwise(0.0)
        rows.append(F.struct(F.lit(metric).alias("metric"), share.alias("value"), F.lit(float(ok)).alias("target"), status(share, ok, warn).alias("status")))
    for i, (metric, (_, bound, kind)) in enumerate(counts.items()):
        v = F.coalesce(f"c{i}", F.lit(0.0))
        good = v <= bound if kind == "most" else v >= bound
        rows.append(F.struct(F.lit(metric).alias("metric"), v.alias("value"), F.lit(float(bound)).alias("target"), F.when(good, "OK").otherwise("BLOCK" if kind == "blocks" else "WARN").alias("status")))
    return one.select(F.lit(area).alias("area"), F.explode(F.array(*rows)).alias("x")).select("area", "x.*")


def fills(columns: dict[str, tuple[float, float]]) -> dict[str, tuple[Column, float, float]]:
    """Ratios of filled values for ``checks``: column to (ok, warn)."""
    return {f"{c}_fill": (filled(c), ok, warn) for c, (ok, warn) in columns.items()}


def dictionary_checks(df: DataFrame, area: str, columns: dict[str, str], dictionary: DataFrame) -> DataFrame:
    """For each column (to a label group) the rows whose value the dictionary (label_group, label_value) lacks, nulls among them, in one pass."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.lit(g).alias("label_group"), F.col(c).cast("string").alias("label_value")) for c, g in columns.items()])).alias("x")).select("x.*")
    sums = cells.groupBy("metric", "label_group", "label_value").agg(F.count(F.lit(1)).alias("n"))
    known = dictionary.select("label_group", "label_value").distinct().withColumn("known", F.lit(True))
    missed = sums.join(known, ["label_group", "label_value"], "left").groupBy("metric").agg(F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).cast("double").alias("value"))
    return missed.select(F.lit(area).alias("area"), F.concat("metric", F.lit("_dictionary_miss")).alias("metric"), "value", F.lit(0.0).alias("target"), F.when(F.col("value") == 0, "OK").otherwise("WARN").alias("status"))


def latest_snapshot(df: DataFrame, column: str) -> DataFrame:
    """The rows of the latest snapshot."""
    return df.join(df.agg(F.max(column).alias(column)), column, "left_semi")


# -- governance of raw documents


def full_text(title: Column, content: Column, least: int = 300) -> Column:
    """Long enough, and neither the title nor what stands after the title's first colon."""
    c, t = F.trim(F.coalesce(content, F.lit(""))), F.trim(F.coalesce(title, F.lit("")))
    return (F.length(F.coalesce(content, F.lit(""))) >= least) & (c != t) & (c != F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), "^[^：:]+[：:]", "")))


def profile_of(source: Column, profiles: list[tuple[str, str]], default) -> Column:
    """The result of the first (LIKE pattern, result) that a source fits."""
    return F.coalesce(*[F.when(source.like(p), r) for p, r in profiles], default if isinstance(default, Column) else F.lit(default))


def families(df: DataFrame, profiles: list[tuple[str, str]], window: Column, good: Column, top_n: int, other: str = "其他") -> DataFrame:
    """(family, rows, good_rows, pct): sources' rows in a window of days by family, the largest first."""
    by = df.groupBy("source").agg(F.count_if(window).alias("n"), F.count_if(window & good).alias("g")).filter("n > 0")
    out = by.groupBy(profile_of(F.col("source"), profiles, other).alias("family")).agg(F.sum("n").alias("rows"), F.sum("g").alias("good_rows"))
    return out.withColumn("pct", F.round(F.col("good_rows") * 100 / F.col("rows"), 2)).orderBy(F.desc("rows"), "family").limit(top_n)


def categories(df: DataFrame, column: str, known: list[str], blank: str = "未填充", other: str = "待规范") -> DataFrame:
    """(category, rows, place): rows by known category, others and blanks summed, in the known order."""
    name = F.when(F.col(column).isin(*known), F.col(column)).when(F.coalesce(F.trim(column), F.lit("")) == "", blank).otherwise(other)
    out = df.groupBy(name.alias("category")).agg(F.count(F.lit(1)).alias("rows"))
    return out.withColumn("place", F.coalesce(*[F.when(F.col("category") == k, i + 1) for i, k in enumerate([*known, other])], F.lit(len(known) + 2))).orderBy("place", "category")


def source_actions(df: DataFrame, good: Column, top_n: int, kept: str = "", few: int = 50) -> DataFrame:
    """(source, rows, nonempty_rows, good_rows, pct, action): what to do about each source, the largest first."""
    by = df.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.trim(F.coalesce("content", F.lit(""))) != "").alias("nonempty_rows"), F.count_if(good).alias("good_rows"))
    by = by.withColumn("pct", F.round(F.col("good_rows") * 100 / F.col("rows"), 2))
    action = F.when(F.col("source") == kept, "keep_fulltext_backfill").when(F.col("rows") < few, "expand_collection").when(F.col("good_rows") == 0, "source_is_thin").when(F.col("pct") < 50, "improve_fulltext_fill_rate").otherwise("keep_collecting")
    return by.withColumn("action", action).orderBy(F.desc("rows"), "source").limit(top_n)


def category_updates(df: DataFrame, key: str, column: str, profiles: list[tuple[str, str]]) -> DataFrame:
    """(key, column): rows whose category differs from that of their source's profile, with the right one."""
    right = profile_of(F.col("source"), profiles, F.col("source"))
    return df.filter(F.col("source").isNotNull()).withColumn("_right", right).filter(~F.col(column).eqNullSafe(F.col("_right"))).select(key, F.col("_right").alias(column))


# -- reports


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, share): filled values by field, 0 for fields that aren't there."""
    one = df.agg(*[(F.coalesce(F.avg(filled(f).cast("double")), F.lit(0.0)) if f in df.columns else F.lit(0.0)).alias(f"f{i}") for i, f in enumerate(fields)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f{i}").alias("share")) for i, f in enumerate(fields)])).alias("x")).select("x.*")


def _truth(c: str) -> Column:
    v = F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    return F.when(v.isin("true", "false"), v == "true")


def accuracy(df: DataFrame, manual: str, predicted: str) -> DataFrame:
    """One row (correct, reviewed, share): predictions that agree with reviews."""
    agree = F.lower(F.trim(F.coalesce(F.col(manual).cast("string"), F.lit("")))) == F.lower(F.trim(F.coalesce(F.col(predicted).cast("string"), F.lit(""))))
    one = df.agg(F.count_if(_truth(manual).isNotNull() & agree).alias("correct"), F.count_if(_truth(manual).isNotNull()).alias("reviewed"))
    return one.withColumn("share", F.when(F.col("reviewed") > 0, F.col("correct") / F.col("reviewed")).otherwise(0.0))


def wrong_reasons(df: DataFrame, manual: str, predicted: str, reasons: list[str], top_n: int, default: str = "未填写原因") -> DataFrame:
    """(reason, n): why predictions differ from reviews, the most frequent first."""
    why = F.coalesce(*[F.nullif(F.trim(r), F.lit("")) for r in reasons], F.lit(default))
    return df.filter(_truth(manual) != _truth(predicted)).groupBy(why.alias("reason")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(top_n)


def link_quality(links: DataFrame, events: DataFrame, event: str = "event_id", kind: str = "link_type") -> DataFrame:
    """(metric, value): events, links, covered events, coverage, mean score, and links by kind."""
    of = links.agg(F.count(F.lit(1)).cast("double").alias("links"), F.countDistinct(event).cast("double").alias("covered"), F.avg("score").alias("mean"))
    one = of.crossJoin(events.agg(F.count(F.lit(1)).cast("double").alias("events")))  # two rows of aggregates
    share = F.when(F.col("events") > 0, F.round(F.col("covered") * 100 / F.col("events"), 2)).otherwise(0.0)
    cells = [("events", F.col("events")), ("links", F.col("links")), ("covered_events", F.col("covered")), ("coverage_pct", share), ("mean_score", F.round("mean", 4))]
    total = one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in cells])).alias("x")).select("x.*")
    return total.unionByName(links.groupBy(F.concat(F.lit("type:"), kind).alias("metric")).agg(F.count(F.lit(1)).cast("double").alias("value")))


def count_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(name, rows, change): table counts against the last snapshot; a table that wasn't there has no change."""
    return now.join(before.select("name", F.col("rows").alias("_b")), "name", "left").select("name", "rows", (F.col("rows") - F.col("_b")).alias("change"))


def validation(candidates: DataFrame, structured: DataFrame, enums: dict[str, tuple], required: list[str], version: str, threshold: int) -> DataFrame:
    """(check, violations) of a classified batch: rows there, both kinds, consistent duplicates, fields, decision and labels."""
    sizes = candidates.groupBy("dedup_key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_event")).alias("events"), F.sum(F.when(F.col("is_event") != (F.col("score") >= threshold), 1).otherwise(0)).alias("decision"), F.min("duplicate_group_size").alias("lo"), F.max("duplicate_group_size").alias("hi"))
    one = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("events"), F.lit(0)).alias("e"), F.coalesce(F.sum("decision"), F.lit(0)).alias("d"), F.coalesce(F.sum(F.when((F.col("lo") != F.col("n")) | (F.col("hi") != F.col("n")), F.col("n")).otherwise(0)), F.lit(0)).alias("dup"))
    there = [c for c in enums if c in structured.columns]
    labels = [F.count_if(~F.coalesce(F.col(c).isin(*enums[c]), F.lit(False))).alias(f"enum_{c}") for c in there]
    versions = F.count_if(~F.coalesce(F.contains("classification_evidence", F.lit(f"rule_version={version}")), F.lit(False))) if "classification_evidence" in structured.columns else F.count(F.lit(1))
    two = structured.agg(F.count(F.lit(1)).alias("s"), versions.alias("rule_version"), *labels)
    both = one.crossJoin(two)  # two rows of aggregates
    n_missing = sum(c not in structured.columns for c in required)
    cells = {
        "non_empty": (F.col("n") == 0).cast("long") + (F.col("s") == 0).cast("long"),
        "event_balance": (F.col("e") == 0).cast("long") + (F.col("e") == F.col("n")).cast("long") + (F.col("s") > F.col("e")).cast("long"),
        "dedup_consistency": F.col("dup"), "required_fields": F.lit(n_missing).cast("long"), "decision_threshold": F.col("d"), "rule_version": F.col("rule_version"), **{f"enum_{c}": F.col(f"enum_{c}") for c in there},
    }
    return both.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), v.cast("long").alias("violations")) for k, v in cells.items()])).alias("x")).select("x.*")
