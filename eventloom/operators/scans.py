"""Scans that feed jobs: sources and their profiles, active companies, rows of sentiment, reasons for a model, labels of studied samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Fixed values: (source, family, patterns, category, kind of collector, target of rows, body needed) of the published sources.
_BODY_TARGET = 2000
PROFILES = (
    ("cninfo-disclosure", "CNInfo 历史公告", ("巨潮资讯网/历史公告",), "公司行为事件", "symbol", 0, False),
    ("cninfo-latest", "CNInfo 最新公告", ("巨潮资讯网/最新公告",), "公司行为事件", "symbol", 0, False),
    ("yicai-news", "第一财经", ("第一财经/%", "第一财经"), "宏观/地缘事件", "media", _BODY_TARGET, True),
    ("eastmoney-industry", "东方财富行业资讯", ("东方财富/行业资讯", "东方财富网"), "行业/技术事件", "media", _BODY_TARGET, True),
    ("gov-news", "中国政府网", ("中国政府网/%", "中国政府网"), "政策类事件", "policy", _BODY_TARGET, True),
    ("ndrc-policy", "国家发改委", ("国家发改委/%",), "政策类事件", "policy", _BODY_TARGET, True),
    ("csrc-policy", "中国证监会", ("中国证监会/%",), "政策类事件", "policy", _BODY_TARGET, True),
    ("miit-policy", "工信部", ("工信部/%",), "政策类事件", "policy", _BODY_TARGET, True),
    ("kr36-flash", "36氪", ("36氪/%", "36氪"), "行业/技术事件", "media", _BODY_TARGET, False),
    ("caixin-mini", "财新网", ("财新网/%", "财新网"), "宏观/地缘事件", "media", _BODY_TARGET, False),
    ("sse-announcements", "上交所公告", ("上交所/%", "上交所"), "公司行为事件", "exchange", _BODY_TARGET, False),
    ("szse-announcements", "深交所公告", ("深交所/上市公司公告",), "公司行为事件", "exchange", _BODY_TARGET, False),
    ("szse-suspension", "深交所停复牌", ("深交所/停复牌公告",), "公司行为事件", "exchange", _BODY_TARGET, False),
    ("akshare-news", "AKShare/EastMoney 新闻聚合", ("AKShare/EastMoney/%",), "公司行为事件", "symbol", _BODY_TARGET, False),
)
SUSPENSION = ("停牌", "复牌", "停复牌")
VALUED_SOURCES = ("中国政府网", "国家发展改革委", "中国证监会", "上交所", "深交所", "巨潮资讯网", "财新", "第一财经")


def source_profiles(spark: SparkSession, replenished_only: bool = False) -> DataFrame:
    """A row for each pattern of each published source; ``replenished_only`` leaves out those without a target."""
    rows = [(name, family, p, category, kind, target, body) for name, family, patterns, category, kind, target, body in PROFILES if target or not replenished_only for p in patterns]
    return spark.createDataFrame(rows, "history_source string, source_family string, pattern string, raw_event_category string, collector_family string, target_rows int, requires_body boolean")


def source_progress(docs: DataFrame, good: Column, forced: bool = False) -> DataFrame:
    """Rows, rows with a good body, gap to the target and whether to run, for each published source.

    Sources that need bodies are counted by them.  A source runs if it is
    forced, has no target, or lacks rows.  A row that fits several patterns of a
    source counts once.
    """
    aggs = []
    for name, _, patterns, *_ in PROFILES:
        fits = F.lit(False)
        for p in patterns:
            fits = fits | F.coalesce(F.col("source").like(p), F.lit(False))
        aggs += [F.count_if(fits).alias(f"n_{name}"), F.count_if(fits & F.coalesce(good, F.lit(False))).alias(f"b_{name}")]
    counts = docs.agg(*aggs)
    rows = []
    for name, family, _, _, _, target, body in PROFILES:
        have = F.col(f"b_{name}" if body else f"n_{name}")
        gap = F.greatest(F.lit(target) - have, F.lit(0)).cast("long")
        rows.append(F.struct(F.lit(name).alias("history_source"), F.lit(family).alias("source_family"), F.col(f"n_{name}").alias("rows"), F.col(f"b_{name}").alias("body_rows"), gap.alias("gap"), (F.lit(forced or not target) | (gap > 0)).alias("runs")))
    return counts.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def suspension(title: Column, category: Column) -> Column:
    """Whether an announcement is of a suspended or resumed security."""
    return T.any_hit(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(category, F.lit(""))), SUSPENSION)


def active_companies(companies: DataFrame, only_unsettled: bool = False, without_legacy: bool = False, offset: int = 0, limit: int = 0) -> DataFrame:
    """Active companies by code, a page of them if asked; ``only_unsettled`` those whose industry is no standard code, ``without_legacy`` no specially treated or delisted names."""
    found = companies.filter("is_active")
    if only_unsettled:
        code = F.col("industry_l1")
        found = found.filter(code.isNull() | (code == "其他") | ~code.rlike("^[A-Y][0-9]{2}"))
    if without_legacy:
        found = found.filter(~F.col("company_name").rlike("退|^PT|^\\*ST|^ST|^S\\*ST"))
    ordered = found.orderBy("ts_code").offset(max(offset, 0))
    return ordered.limit(limit) if limit > 0 else ordered


def sentiment_rows(events: DataFrame, candidates: DataFrame, documents: DataFrame, memberships: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows for the sentiment aggregates: each event with its document's source and title, under its canonical cluster or by itself."""
    doc = documents.select(F.col("id").alias("raw_document_id"), F.col("source").alias("raw_source"), F.col("title").alias("raw_title"))
    of = candidates.select(F.col("id").alias("candidate_id"), "raw_document_id")
    known = memberships.select("structured_event_id", "canonical_event_id").join(clusters.select("canonical_event_id").distinct(), "canonical_event_id", "left_semi")
    joined = events.join(of, "candidate_id").join(doc, "raw_document_id").join(known.withColumnRenamed("structured_event_id", "id"), "id", "left")
    return joined.select(F.coalesce("canonical_event_id", "event_id").alias("canonical_event_id"), F.to_date("event_date").alias("stat_date"), "source_type", "authority_level", "sentiment", "heat_score", "raw_source", "raw_title")


def model_reasons(score: Column, threshold: int, source: Column, industry: Column, subject: Column, duplicates: Column, valued: tuple[str, ...] = VALUED_SOURCES, no_industry: str = "其他", default_subject: str = "行业类") -> Column:
    """Why an event should go to a model, as a list in a fixed order; empty if it need not."""
    rules = (
        ("borderline_score", F.abs(score - threshold) <= 1),
        ("high_value_source", T.any_hit(F.coalesce(source, F.lit("")), valued)),
        ("industry_other", industry == no_industry),
        ("subject_default", subject == default_subject),
        ("duplicate_cluster", duplicates >= 3),
    )
    return F.array_compact(F.array(*(F.when(holds, reason) for reason, holds in rules)))


def label_map(labels: DataFrame, order: str) -> DataFrame:
    """Labels by (structured_event_id, ts_code) from rows of text, the last row of a key by ``order`` and then by its values; rows without a number and code are left out."""
    sid = F.trim(F.coalesce("structured_event_id", F.lit(""))).try_cast("long")
    code = F.upper(F.trim(F.coalesce("ts_code", F.lit(""))))
    number = lambda c: F.trim(F.col(c)).try_cast("double").alias(f"label_{c}")
    filled = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    origin = F.regexp_replace(F.concat(F.trim(F.coalesce("benchmark_source", F.lit(""))), F.lit("|"), F.trim(F.coalesce("stock_source", F.lit("")))), "^\\|+|\\|+$", "")
    rows = labels.select(
        sid.alias("structured_event_id"), code.alias("ts_code"), *map(number, ("car_w1", "car_w3", "car_w5")), filled("event_trade_date").alias("event_trade_date"), filled("event_date_alignment").alias("event_trade_alignment_type"),
        F.when(origin == "", "event_study").otherwise(origin).alias("label_source"), F.col(order).alias("order"),
    ).filter("structured_event_id IS NOT NULL AND ts_code <> ''")
    last = rows.groupBy("structured_event_id", "ts_code").agg(F.max_by(F.struct(*rows.columns), F.struct("order", *rows.columns)).alias("r"))
    return last.select("r.*").drop("order")


def labelled(samples: DataFrame, labels: DataFrame) -> DataFrame:
    """Samples (structured_event_id, ts_code, ...) with their labels, and whether each abnormal return was positive (null without one)."""
    joined = samples.join(labels, ["structured_event_id", "ts_code"], "left")
    return joined.withColumns({f"up_{w}": F.col(f"label_car_{w}") > 0 for w in ("w1", "w3", "w5")})


def stale(old: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` that a whole run no longer has, of any group: those to delete."""
    return old.join(current.select(*keys).distinct(), keys, "left_anti")


def profiles_upserted(old: DataFrame, new: DataFrame, table_source: str = "companies_table") -> DataFrame:
    """Company profiles by (ts_code, snapshot_date): the new row's names and tags, the new facts where it has them, and its customers, suppliers and source unless it only comes from the companies' table."""
    keys, replaced = ["ts_code", "snapshot_date"], ["company_name", "exchange", "industry_l1", "industry_l2", "concept_tags"]
    kept = ["region", "list_date", "state_owned_flag", "company_type", "business_scope", "core_products", "employees", "total_shares", "float_shares"]
    o, n = old.alias("o"), new.withColumn("new_row", F.lit(True)).alias("n")
    fresh_row, own = F.col("n.new_row").isNotNull(), F.col("n.data_source") != table_source
    had = F.col("o.data_source").isNotNull()
    listed = lambda c: F.when(~fresh_row, F.col(f"o.{c}")).when(own | ~had | (F.col(f"o.{c}") == "[]"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    columns = [*keys, *(F.when(fresh_row, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in replaced), *(F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in kept), listed("main_customers"), listed("main_suppliers")]
    return o.join(n, keys, "full").select(*columns, F.when(~fresh_row, F.col("o.data_source")).when(own | ~had, F.col("n.data_source")).otherwise(F.col("o.data_source")).alias("data_source"))


def latest_reasons(outcomes: DataFrame, n: int) -> DataFrame:
    """The n most frequent reasons why samples can't be computed, equal counts by name: a top-k report."""
    counts = outcomes.filter(F.col("reason") != "").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rows"), "reason"))).filter(F.col("rank") <= n)  # a row for each reason
