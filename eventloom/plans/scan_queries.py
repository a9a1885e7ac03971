"""Queries of the scans that feed jobs, and of nested search results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, scans
from ..sources import paged, variants
from . import bindings as b
from . import event_queries as e
from .event_queries import _q

_PLACES = sorted({p.replace("%", "x") for _, _, patterns, *_ in scans.PROFILES for p in patterns}) + ["elsewhere"]


def source_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, bodies, gaps and decisions of the published sources; documents take a source by their ids."""
    d = e.documents(spark, sf_dir)
    place = F.get(F.array(*map(F.lit, _PLACES)), (F.col("doc_id") % len(_PLACES)).cast("int"))
    return scans.source_progress(d.withColumn("source", F.when(F.col("doc_id") % 50 > 0, place)), quality.good_body(F.col("title"), F.col("content"), 300))


def active_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active customers whose industry is no standard code and whose name isn't marked."""
    k = F.col("c_custkey")
    c = b.table(spark, sf_dir, "customer").select(
        F.lpad(k.cast("string"), 8, "0").alias("ts_code"), (k % 7 > 0).alias("is_active"), F.concat(F.when(k % 5 == 0, "*ST").when(k % 11 == 0, "PT").otherwise(""), F.col("c_name"), F.when(k % 13 == 0, "退").otherwise("")).alias("company_name"),
        F.when(k % 4 == 0, "C39 parts").when(k % 4 == 1, "其他").when(k % 4 == 2, F.col("c_mktsegment")).alias("industry_l1"),
    )
    return scans.active_companies(c, only_unsettled=True, without_legacy=True).select("ts_code", "company_name", "industry_l1")


def sentiment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for the sentiment aggregates from events, their candidates, documents, and clusters of which some are gone."""
    d = e.documents(spark, sf_dir)
    i = F.col("doc_id")
    events = d.select((i * 2).alias("id"), F.concat(F.lit("E"), i).alias("event_id"), (i + 3).alias("candidate_id"), F.col("publish_time").alias("event_date"), F.lit("press").alias("source_type"), F.col("lang").alias("authority_level"), F.when(i % 2 == 0, "good").otherwise("bad").alias("sentiment"), (i % 100).alias("heat_score"))
    candidates = d.filter("doc_id % 10 <> 9").select((i + 3).alias("id"), i.alias("raw_document_id"))
    members = d.filter("doc_id % 3 = 0").select((i * 2).alias("structured_event_id"), F.concat(F.lit("C"), i % 20).alias("canonical_event_id"))
    clusters = d.filter("doc_id % 20 < 15").select(F.concat(F.lit("C"), i % 20).alias("canonical_event_id")).distinct()
    docs = d.select(i.alias("id"), "source", "title")
    return scans.sentiment_rows(events, candidates, docs, members, clusters).withColumn("raw_title", F.md5(F.col("raw_title").cast("binary")))


def model_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why documents should go to a model, by their detection score, source and labels."""
    d = b.table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    reasons = scans.model_reasons((i % 8).cast("int"), 2, F.col("source"), F.when(i % 3 == 0, "其他").otherwise("x"), F.when(i % 5 == 0, "行业类"), i % 4, ("src1", "src22"))
    return d.select("doc_id", F.array_join(reasons, ",").alias("reasons"))


def labelled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as samples with the last label of their order and supplier."""
    l = b.table(spark, sf_dir, "lineitem")  # noqa: E741
    k, s = F.col("l_orderkey"), F.col("l_suppkey")
    text = l.select(
        F.when(k % 9 == 0, "bad").otherwise(F.concat(F.lit(" "), k)).alias("structured_event_id"), F.when(s % 17 == 0, "").otherwise(F.concat(F.lit("s"), s)).alias("ts_code"), (F.col("l_discount") - 0.05).cast("decimal(6,2)").cast("string").alias("car_w1"),
        F.when(k % 4 == 0, "x").otherwise((F.col("l_tax") - 0.04).cast("decimal(6,2)").cast("string")).alias("car_w3"), F.lit("").alias("car_w5"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("event_trade_date"), F.lit(" ").alias("event_date_alignment"),
        F.when(k % 2 == 0, "api").alias("benchmark_source"), F.when(k % 3 == 0, "file").otherwise("").alias("stock_source"), (F.col("l_linenumber") + k * 10).alias("line"),
    )
    samples = l.select(k.alias("structured_event_id"), F.concat(F.lit("S"), s).alias("ts_code")).distinct()
    return scans.labelled(samples, scans.label_map(text, "line")).drop("label_car_w5", "event_trade_alignment_type", "up_w5")


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items of pages of nested results in five shapes, and pages that are malformed, read back by paths."""
    i = F.col("doc_id")
    body = F.concat(F.lit("body "), i)
    element = lambda name, value: F.concat(F.lit(f'{{"fieldName":"{name}","fieldValue":"'), value, F.lit('"}'))
    listed = F.concat(F.lit('{"elementList":['), element("Source", F.lit("x")), F.lit(","), element(" CONTENT", F.lit("<p> </p>")), F.lit(","), element("content", F.concat(F.lit("<p>"), body, F.lit("</p>"))), F.lit("]}"))
    plain = F.concat(F.lit('"infocontent":"<b>'), body, F.lit('</b>"'))
    shape = F.when(i % 5 == 0, F.concat(F.lit('"infoextends":'), listed)).when(i % 5 == 1, F.concat(F.lit('"infoextends":"'), F.replace(listed, F.lit('"'), F.lit('\\"')), F.lit('"')))
    shape = shape.when(i % 5 == 2, F.concat(F.lit('"infoextends":"{bad",'), plain)).when(i % 5 == 3, F.concat(F.lit('"infoextends":7,'), plain)).otherwise(F.lit('"infoextends":{"elementList":null}'))
    time = F.when(i % 3 == 0, '"jsearch_date":"2024-01-02",').when(i % 3 == 1, F.concat(F.lit('"createdate":'), (F.lit(1704067200) + i % 365 * 86400) * 1000, F.lit(","))).otherwise('"jsearch_date":"","deploytime":"2024-03-04",')
    data = F.concat(F.lit('{"title":"T '), i, F.lit('","url":"/u/'), i, F.lit('",'), time, shape, F.lit("}"))
    item = F.when(i % 2 == 0, F.concat(F.lit('{"groupData":[{"data":'), data, F.lit("}]}"))).otherwise(data)
    pages = b.table(spark, sf_dir, "documents").select(F.floor(i / 10).alias("page"), i.alias("at"), item.alias("item")).groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]), ",").alias("items"))
    whole = F.concat(F.lit('{"data":{"searchResult":{"dataResults":['), F.col("items"), F.lit("]}}"))
    payload = F.when(F.col("page") % 9 == 8, whole).otherwise(F.concat(whole, F.lit("}")))
    return variants.search_items(pages.select("page", payload.alias("payload")), "payload", base="https://example.org")


def paged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stored as pages, newest first, and read back for a range of days; suspensions are marked."""
    d = e.documents(spark, sf_dir)
    i = F.col("doc_id")
    rows = d.select(F.concat(F.when(i % 7 == 0, "复牌 ").otherwise(""), F.lit("T"), i).alias("title"), F.md5(F.coalesce("content", F.lit("")).cast("binary")).alias("content"), F.date_format("publish_time", "yyyy-MM-dd HH:mm:ss").alias("publish_time"), F.concat(F.lit("u"), i).alias("url"), F.col("source").alias("category"))
    path = f"{b.shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    paged.write_pages(rows, path, 50, [(-F.unix_timestamp("publish_time")).alias("t"), F.col("url")])
    found = paged.history(spark, path, "2024-03-01", "2024-05-31")
    return found.select("title", "content", "publish_time", "url", scans.suspension(F.col("title"), F.lit("")).alias("suspended"))


QUERIES = {f.__name__: f for f in (source_progress, active_companies, sentiment_rows, model_reasons, labelled_samples, search_results, paged_history)}


def _progress_sql() -> str:
    place = f"CASE WHEN doc_id % 50 > 0 THEN [{', '.join(map(_q, _PLACES))}][doc_id % {len(_PLACES)} + 1] END"
    parts = []
    for name, family, patterns, _, _, target, body in scans.PROFILES:
        fits = "(" + " OR ".join(f"source LIKE {_q(p)}" for p in patterns) + ")"
        have = f"count(*) FILTER ({fits} AND good)" if body else f"count(*) FILTER ({fits})"
        parts.append(f"SELECT {_q(name)} AS history_source, {_q(family)} AS source_family, count(*) FILTER ({fits}) AS rows, count(*) FILTER ({fits} AND good) AS body_rows, greatest({target} - {have}, 0) AS gap, {str(not target).lower()} OR {target} - {have} > 0 AS runs FROM p")
    return f"WITH {e._DOCS}, p AS (SELECT {place} AS source, {e._BODY} AS good FROM docs) " + " UNION ALL ".join(parts)


ORACLE_SQL = {
    "source_progress": _progress_sql(),
    "active_companies": """WITH c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS ts_code, c_custkey % 7 > 0 AS is_active, CASE WHEN c_custkey % 5 = 0 THEN '*ST' WHEN c_custkey % 11 = 0 THEN 'PT' ELSE '' END || c_name || CASE WHEN c_custkey % 13 = 0 THEN '退' ELSE '' END AS company_name,
  CASE c_custkey % 4 WHEN 0 THEN 'C39 parts' WHEN 1 THEN '其他' WHEN 2 THEN c_mktsegment END AS industry_l1 FROM customer)
SELECT ts_code, company_name, industry_l1 FROM c WHERE is_active AND (industry_l1 IS NULL OR industry_l1 = '其他' OR NOT regexp_matches(industry_l1, '^[A-Y]\\d{2}')) AND NOT regexp_matches(company_name, '退|^PT|^\\*ST|^ST|^S\\*ST')""",
    "sentiment_rows": f"""WITH {e._DOCS} SELECT CASE WHEN doc_id % 3 = 0 AND 'C' || (doc_id % 20) IN (SELECT 'C' || (doc_id % 20) FROM docs WHERE doc_id % 20 < 15) THEN 'C' || (doc_id % 20) ELSE 'E' || doc_id END AS canonical_event_id, CAST(publish_time AS DATE) AS stat_date, 'press' AS source_type, lang AS authority_level,
  CASE WHEN doc_id % 2 = 0 THEN 'good' ELSE 'bad' END AS sentiment, doc_id % 100 AS heat_score, source AS raw_source, md5(title) AS raw_title FROM docs WHERE doc_id % 10 <> 9""",
    "model_reasons": """SELECT doc_id, concat_ws(',', CASE WHEN abs(doc_id % 8 - 2) <= 1 THEN 'borderline_score' END, CASE WHEN contains(source, 'src1') OR contains(source, 'src22') THEN 'high_value_source' END, CASE WHEN doc_id % 3 = 0 THEN 'industry_other' END,
  CASE WHEN doc_id % 5 = 0 THEN 'subject_default' END, CASE WHEN doc_id % 4 >= 3 THEN 'duplicate_cluster' END) AS reasons FROM documents""",
    "labelled_samples": """WITH t AS (SELECT l_orderkey AS k, l_suppkey AS s, CAST(CAST(l_discount - 0.05 AS DECIMAL(6,2)) AS DOUBLE) AS w1, CASE WHEN l_orderkey % 4 <> 0 THEN CAST(CAST(l_tax - 0.04 AS DECIMAL(6,2)) AS DOUBLE) END AS w3, strftime(l_shipdate, '%Y-%m-%d') AS day,
  CASE WHEN l_orderkey % 2 = 0 THEN CASE WHEN l_orderkey % 3 = 0 THEN 'api|file' ELSE 'api' END WHEN l_orderkey % 3 = 0 THEN 'file' ELSE 'event_study' END AS origin FROM lineitem WHERE l_orderkey % 9 <> 0 AND l_suppkey % 17 <> 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber DESC, w1 DESC, w3 DESC NULLS LAST, day DESC, origin DESC) = 1)
SELECT DISTINCT l_orderkey AS structured_event_id, 'S' || l_suppkey AS ts_code, w1 AS label_car_w1, w3 AS label_car_w3, day AS event_trade_date, origin AS label_source, w1 > 0 AS up_w1, w3 > 0 AS up_w3 FROM lineitem LEFT JOIN t ON k = l_orderkey AND s = l_suppkey""",
    "paged_history": f"""WITH {e._DOCS} SELECT CASE WHEN doc_id % 7 = 0 THEN '复牌 ' ELSE '' END || 'T' || doc_id AS title, md5(coalesce(content, '')) AS content, strftime(publish_time, '%Y-%m-%d %H:%M:%S') AS publish_time, 'u' || doc_id AS url, doc_id % 7 = 0 AS suspended
  FROM docs WHERE CAST(publish_time AS DATE) BETWEEN DATE '2024-03-01' AND DATE '2024-05-31'""",
    "search_results": """SELECT doc_id // 10 AS page, 'T ' || doc_id AS title, CASE doc_id % 3 WHEN 0 THEN '2024-01-02' WHEN 1 THEN strftime(make_timestamp((1704067200 + doc_id % 365 * 86400) * 1000000), '%Y-%m-%d %H:%M:%S') ELSE '2024-03-04' END AS publish_time,
  'body ' || doc_id AS content, 'https://example.org/u/' || doc_id AS url FROM documents WHERE doc_id % 5 <> 4 AND doc_id // 10 % 9 <> 8""",
}
