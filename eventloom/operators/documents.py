"""Raw documents and what is stored of them: cleaning, keyed upserts, scans, and the final merge of staged events.

``today`` is always a parameter, so that results don't depend on the clock.
Every keyed step is last writer wins by an explicit order column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import upsert
from .tables import fresh

EPOCH = "1970-01-01 00:00:00"


def stored_time(value: Column) -> Column:
    """A timestamp from the usual formats, else the epoch."""
    return F.coalesce(T.normalized_time(T.sanitized(F.coalesce(value, F.lit("")))), F.lit(EPOCH).cast("timestamp"))


def history_date(value: Column) -> Column:
    """A date as text from four formats, else the first ten characters."""
    t = F.trim(F.coalesce(value, F.lit("")))
    cut = F.substring(t, 1, 19)
    parsed = F.coalesce(*[F.try_to_timestamp(cut, F.lit(f)) for f in ("yyyy-MM-dd", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm")])
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.substring(t, 1, 10))


def in_range(value: Column, first: str, last: str, inclusive: bool = True) -> Column:
    """Whether a date as text lies between two days, with the last or without it."""
    day = history_date(value)
    return (day != "") & (day >= first) & ((day <= last) if inclusive else (day < last))


def with_url(rows: DataFrame) -> DataFrame:
    """A made-up url for documents without one, from source, title and time."""
    digest = F.md5(F.concat_ws("::", F.coalesce("title", F.lit("None")), F.coalesce("publish_time", F.lit("None"))).cast("binary"))
    made = F.concat(F.lit("local://history/"), F.coalesce("source", F.lit("unknown")), F.lit("/"), digest)
    return rows.withColumn("url", F.coalesce(F.nullif("url", F.lit("")), made))


def deduplicated(rows: DataFrame, order: str) -> DataFrame:
    """The last row of each url, made-up ones included."""
    return upsert.last_wins(with_url(rows), ["url"], order)


def prepared(rows: DataFrame, today: str) -> DataFrame:
    """Documents as stored: without control characters, never empty, not of the future, with a hash of title and content."""
    clean = lambda c, default="": T.sanitized(F.coalesce(c, F.lit(default)))
    title, content = F.trim(clean("title")), F.trim(clean("content"))
    content = F.when(content != "", content).when(title != "", title).otherwise("(empty)")
    d = rows.withColumns({"source": clean("source", "unknown"), "url": clean("url"), "symbol_or_subject": clean("symbol_or_subject"), "title": title, "content": content, "publish_time": stored_time(F.col("publish_time"))})
    d = d.filter(F.to_date("publish_time") <= F.lit(today).cast("date"))
    return d.withColumns({"source_type": F.lit("text_source"), "content_hash": F.md5(F.concat("title", F.lit("::"), "content").cast("binary"))})


def upserted(old: DataFrame, new: DataFrame, today: str, order: str) -> DataFrame:
    """Stored documents after a batch: the batch's last row of each url in place of the stored one."""
    batch = upsert.last_wins(prepared(new, today), ["url"], order).select(*old.columns)
    return upsert.upserted(old, batch, ["url"])


def content_update(rows: DataFrame) -> DataFrame:
    """(id, content, content_hash): bodies with white space collapsed, as updates by id."""
    content = F.trim(F.regexp_replace("content", T.SPACE, " "))
    return rows.select("id", content.alias("content"), F.md5(F.concat("title", F.lit("::"), content).cast("binary")).alias("content_hash"))


def longer_body(rows: DataFrame, bodies: DataFrame, key: str) -> DataFrame:
    """``rows`` with a body from ``bodies`` (key, body) where that is longer than the content."""
    joined = rows.join(bodies.select(key, F.col("body").alias("_body")), key, "left")
    return joined.withColumn("content", F.when(F.length("_body") > F.length(F.coalesce("content", F.lit(""))), F.col("_body")).otherwise(F.col("content"))).select(*rows.columns)


def newest_first(docs: DataFrame) -> DataFrame:
    """All documents, the latest first."""
    return docs.orderBy(F.desc("publish_time"), "url")


def page_of_source(docs: DataFrame, source: str, offset: int, limit: int) -> DataFrame:
    """One page of a source's documents, the latest first."""
    return newest_first(docs.filter(F.col("source") == source)).offset(offset).limit(limit)


def backfill_candidates(docs: DataFrame, least: int, shards: int = 1, shard: int = 0, after: int = 0) -> DataFrame:
    """Documents whose body is too short or the title, of one shard by their place in the order of ids above ``after``."""
    content, title = F.trim(F.coalesce("content", F.lit(""))), F.trim(F.coalesce("title", F.lit("")))
    needy = docs.filter((F.col("id") > after) & ((F.length(content) < least) | (content == title)))
    return upsert.sharded(needy, "id", shards, shard) if shards > 1 else needy


def batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    """``rows`` with the number of their batch of ``size`` rows in the order of a unique column."""
    place = fresh(rows, "place")
    return upsert.numbered(rows, order, place).withColumn("batch", F.floor(F.col(place) / size).cast("long")).drop(place)


# -- the final merge

#: Defaults of staged text columns and their types; a blank takes the default.
STRUCTURED = {
    "source_type": ("string", "其他来源"), "authority_level": ("string", "general_media"), "source_credibility_score": ("double", 1.0), "event_subject_subtype": ("string", "未细分"), "time_orientation": ("string", "current_confirmed"),
    "event_stage": ("string", "确认"), "shock_source_type": ("string", "其他"), "region_scope": ("string", "domestic"), "trigger_word_score": ("int", 0), "explicitness_score": ("int", 0), "uncertainty_score": ("int", 0), "novelty_score": ("int", 50),
    "amount_scale": ("string", "none"), "amount_max_rmb": ("double", None), "amount_log_rmb": ("double", None), "event_code": ("string", ""), "sw_l1_industry": ("string", "其他"), "sw_l1_industry_code": ("string", ""), "sentiment_score_0_100": ("int", 50),
    "source_credibility_type": ("string", "单一媒体"), "company_count": ("int", 0), "industry_count": ("int", 0), "province_count": ("int", 0), "city_count": ("int", 0), "country_count": ("int", 0), "chain_stage_count": ("int", 0), "chain_stages": ("string", "[]"),
    "report_count": ("int", 0), "media_coverage_count": ("int", 0), "heat_growth_rate": ("double", 0.0), "heat_duration_days": ("int", 0), "disagreement_score": ("double", 0.0), "classification_confidence": ("double", 0.5), "heat_score": ("int", None),
    "intensity_score": ("int", None), "event_date": ("date", None),
}


def candidate_merge(stage: DataFrame, docs: DataFrame, old: DataFrame) -> DataFrame:
    """Stored candidates (raw_document_id, dedup_key, duplicate_group_size, is_event, filter_reason, evidence, score_hint) after a stage of text columns."""
    size, event, hint = (F.nullif(F.trim(c), F.lit("")).try_cast(t).alias(c) for c, t in (("duplicate_group_size", "int"), ("is_event", "boolean"), ("score_hint", "int")))
    new = stage.join(docs.select(F.col("id").alias("raw_document_id"), F.col("url").alias("raw_document_url")), "raw_document_url")
    new = new.select("raw_document_id", "dedup_key", size, event, "filter_reason", "evidence", hint)
    return upsert.upserted(old, new.select(*old.columns), ["raw_document_id"])


def structured_merge(stage: DataFrame, docs: DataFrame, staged_candidates: DataFrame, candidates: DataFrame, old: DataFrame) -> DataFrame:
    """Stored events after a stage: joined to their documents' candidates, blanks defaulted, and without those whose candidate is no event any more.

    ``candidates`` are the stored ones after ``candidate_merge``; the key is raw_document_id.
    """
    types = {c: STRUCTURED[c][0] for c in stage.columns if c in STRUCTURED}
    defaults = {c: STRUCTURED[c][1] for c in stage.columns if c in STRUCTURED}
    plain = [c for c in stage.columns if c not in types]
    cast = [F.coalesce(F.nullif(F.trim(c), F.lit("")).try_cast(t), F.lit(defaults[c]).cast(t)).alias(c) for c, t in types.items()]
    urls = docs.select(F.col("id").alias("raw_document_id"), F.col("url").alias("_url"))
    new = stage.join(urls, F.col("raw_text_ref") == F.col("_url")).join(candidates.select("raw_document_id"), "raw_document_id", "left_semi")
    merged = upsert.upserted(old, new.select("raw_document_id", *plain, *cast).select(*old.columns), ["raw_document_id"])
    touched = staged_candidates.join(urls, F.col("raw_document_url") == F.col("_url")).select("raw_document_id")
    demoted = candidates.filter("NOT is_event").join(touched, "raw_document_id", "left_semi").select("raw_document_id")
    return merged.join(demoted, "raw_document_id", "left_anti")


def memberships(canonical: DataFrame, events: DataFrame) -> DataFrame:
    """(canonical_event_id, structured_event_id): all memberships anew; members without a stored event are dropped, of several with one id the last."""
    last = events.groupBy("event_id").agg(F.max("id").alias("structured_event_id"))
    return canonical.select("canonical_event_id", F.explode("members").alias("event_id")).distinct().join(last, "event_id").select("canonical_event_id", "structured_event_id")


def yearly(rows: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Rows of a range of days with their year, to be written partitioned by it."""
    return rows.filter(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).withColumn("year", F.year(day))
