"""Queries on listings, list pages, relative times, caches and health records, all derived from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import panel, retrieval, samples
from ..sources import files
from . import bindings as b
from . import event_queries as e

NOW = "2024-03-05 10:20:30"


def list_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu entries of pages: blocks by a pattern, fields by patterns, the first of each address."""
    p = b.table(spark, sf_dir, "pages").select("page_id", "html")
    found = files.blocks(p, "html", "(?s)<li><a href=.*?</li>", {"href": 'href="([^"]*)"', "title": "(?s)<a [^>]*>(.*?)</a>"}, "href")
    return found.select("page_id", "href", "title")


def page_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of lists: minutes and hours ago, without a year, in full, none; by event."""
    i = F.col("event_id")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    clock = F.concat(two(i % 24), F.lit(":"), two(i % 60))
    day = F.concat(two(i % 12 + 1), F.lit("-"), two(i % 28 + 1))
    value = F.when(i % 5 == 0, F.concat((i % 60).cast("string"), F.lit("分钟前"))).when(i % 5 == 1, F.concat((i % 24).cast("string"), F.lit("小时前"))).when(i % 5 == 2, F.concat(day, F.lit("  "), clock)).when(i % 5 == 3, F.concat(F.lit("2023-"), day, F.lit(" "), clock)).otherwise("soon")
    other = F.when(i % 2 == 0, F.concat(F.lit("at "), two(i % 12 + 1), F.lit("月"), two(i % 28 + 1), F.lit("日 "), clock)).otherwise("none")
    ev = b.table(spark, sf_dir, "events")
    strict = F.date_format(T.strict_time(F.concat(F.lit("2023-"), day, F.when(i % 2 == 0, F.concat(F.lit(" "), clock)).otherwise(""))), "yyyy-MM-dd HH:mm:ss")
    return ev.select("event_id", T.relative_time(value, NOW).alias("relative"), T.yearless_time(other, NOW).alias("yearless"), T.time_or_now(F.when(i % 3 == 0, F.concat(day, F.lit("/2022"))), "MM-dd/yyyy", NOW).alias("or_now"), strict.alias("strict"))


def nested_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as a listing of JSON, a list of lists, taken apart again."""
    l = b.table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(F.col("l_linenumber").alias("no"), F.col("l_returnflag").alias("flag")).alias("x"))  # noqa: E741
    by = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("lines"))
    body = by.select(F.to_json(F.struct(F.array(F.struct(F.col("l_orderkey").alias("id"), F.struct("lines").alias("sub"))).alias("data"))).alias("body"))
    found = files.listing(body, "body", "$.data", {"no": "$.no", "flag": "$.flag"}, "$.sub.lines")
    return found.groupBy("no", "flag").agg(F.count(F.lit(1)).alias("n"))


def event_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a flat JSON listing with a fallback field, taken apart again."""
    ev = b.table(spark, sf_dir, "events")
    item = F.struct(F.col("event_id").alias("id"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("title"), F.col("event_type").alias("name"))
    body = ev.groupBy((F.col("event_id") % 200).alias("g")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("items"))).alias("body"))
    found = files.listing(body, "body", "$.items", {"id": "$.id", "title": "$.title", "name": "$.name"})
    return found.select(F.col("id").cast("long").alias("id"), T.first_filled(F.col("title"), F.concat(F.lit("by "), "name")).alias("title"))


def quote_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of suppliers as comma-separated lines in JSON, taken apart to returns; bad closes break the chain."""
    p = b.prices(spark, sf_dir)
    close = F.when(F.dayofmonth("day") == 13, "bad").otherwise(F.col("close").cast("string"))
    line = F.concat_ws(",", F.date_format("day", "yyyy-MM-dd"), close, F.lit("x"))
    body = p.groupBy("entity").agg(F.to_json(F.struct(F.struct(F.array_sort(F.collect_list(line)).alias("klines")).alias("data"))).alias("body"))
    rows = files.series_lines(body, "body", "$.data.klines", ["day", "close"]).select("entity", "day", F.col("close").try_cast("double").alias("close"))
    r = panel.simple_returns(rows)
    return r.select("entity", "day", "close", (F.floor(F.col("daily_return") * 1e6 + 0.5) / 1e6).alias("daily_return"))


def series_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of event types put into a table of series in two runs and read back; values that are no numbers are gone."""
    ev = b.table(spark, sf_dir, "events")
    by = ev.groupBy(F.col("event_type").alias("key"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    rows = by.select("key", F.concat(F.lit("s:"), "key").alias("source"), "day", F.when(F.substring("day", 9, 2) == "07", "n/a").otherwise(F.col("n").cast("string")).alias("value"))
    path = f"{b.shared_folder(spark)}/series-{uuid.uuid4().hex}"
    files.store_series(spark, path, rows.filter("day < '2024-01-15'").withColumn("value", F.lit("0")))  # an older run, replaced
    files.store_series(spark, path, rows)
    return files.stored_series(spark, path)


def failure_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of failures of events' made-up errors, and the ten most frequent of a report."""
    texts = ("", "Read timed out", "SSL EOF", "KeyError: 'x'", "bad value", "JSONDecodeError", "boom")
    i = F.col("event_id")
    ev = b.table(spark, sf_dir, "events").select("event_id", "event_type", F.element_at(F.array(*[F.lit(x) for x in texts]), (i % 7 + 1).cast("int")).alias("error"), (i % 3).alias("rows"), (i % 7 == 0).alias("success"))
    return ev.select("event_id", files.failure_kind(F.col("error"), F.col("rows"), F.col("success")).alias("kind"))


def top_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent failures by collector: a top-k report."""
    ev = b.table(spark, sf_dir, "events").select(F.col("event_type").alias("collector"), F.when(F.col("event_id") % 4 == 0, "network").otherwise("parse").alias("failure_category"), F.when(F.col("event_id") % 3 == 0, "true").otherwise("false").alias("success"))
    return files.top_failures(ev, 5)


def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of users as sources after a run: read from JSON, failures counted, cooldowns set."""
    u = b.table(spark, sf_dir, "events").select("user_id").distinct()
    state = u.filter("user_id % 3 <> 0").select(F.concat(F.lit("u"), "user_id").alias("k"), F.struct((F.col("user_id") % 4).cast("string").alias("consecutive_failures"), F.when(F.col("user_id") % 5 == 0, "bad").otherwise("100").alias("skip_until_ts"), F.lit("old").alias("last_failure_category")).alias("s"))
    text = state.agg(F.to_json(F.struct(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "s")))).alias("sources"))).alias("body"))
    report = u.filter("user_id % 2 = 0").select(F.concat(F.lit("u"), "user_id").alias("source"), F.when(F.col("user_id") % 4 == 0, "network").otherwise("").alias("failure_category"), F.lit("e").alias("error"))
    return files.after_run(files.health(text, "body"), report, 1000)


def address_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of made-up detail addresses, and the files that derive from them; state of pages' scripts."""
    k = F.col("o_orderkey")
    url = F.concat(F.lit("http://h/p?stockCode=%20"), k, F.lit("&announcementId="), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("A"), k)), F.lit("&announcementTime="), F.when(k % 5 == 0, "2024").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit("%2010"))
    html = F.concat(F.lit("<script>window.initialState = "), F.when(k % 2 == 0, F.concat(F.lit('{"a":'), k, F.lit("}"))).otherwise("{bad"), F.lit("}</script>").substr(F.lit(2), F.lit(20)))
    o = b.table(spark, sf_dir, "orders").select("o_orderkey", url.alias("u"), html.alias("h"))
    item, time = T.query_part(F.col("u"), "announcementId"), T.query_part(F.col("u"), "announcementTime")
    return o.select("o_orderkey", T.query_part(F.col("u"), "stockCode").alias("code"), item.alias("item"), F.array_join(T.derived_files("http://f/", item, time), " ").alias("files"), F.get_json_object(T.state_json(F.col("h")), "$.a").cast("long").alias("state"), T.valid_json(F.when(F.col("o_orderkey") % 2 == 0, '{"x":1}').otherwise("{x"), "[]").alias("json"))


def page_metas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meta tags made of pages' addresses, and plain text of whole pages."""
    p = b.table(spark, sf_dir, "pages")
    html = F.concat(F.lit('<meta name="ArticleTitle" content="'), "url", F.lit('"><META NAME=\'PubDate\' content=\'2024\'>'))
    return p.select("page_id", files.meta_content(html, "ArticleTitle").alias("title"), files.meta_content(html, "pubdate").alias("day"), F.md5(T.without_tags(F.col("html")).cast("binary")).alias("text"))


def cleaned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without control characters, with dates and times read from text."""
    i = F.col("doc_id")
    d = b.table(spark, sf_dir, "documents")
    day = F.date_format(F.timestamp_seconds(F.lit(1704067200) + (i % 365) * 86400), "yyyy-MM-dd")
    date = F.when(i % 4 == 0, day).when(i % 4 == 1, F.translate(day, "-", "/")).when(i % 4 == 2, F.translate(day, "-", "")).otherwise("x")
    text = F.concat(F.lit("a\x02b\x0bc\td\ne"), F.substring("text", 1, 50))
    items = F.when(i % 3 == 0, F.lit('["p", " q "]')).when(i % 3 == 1, F.lit("p、q; ,r|s")).otherwise(F.lit("[bad"))
    listed = F.coalesce(F.array_join(T.list_items(items), "+"), F.lit(""))
    return d.select("doc_id", T.sanitized(text).alias("text"), T.normalized_date(date).alias("date"), T.normalized_time(F.when(i % 2 == 0, F.concat(day, F.lit(" 07:08"))).otherwise("bad")).alias("time"), listed.alias("items"))


def event_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 latest documents with a word in title or body, with the nations of their number's supplier: top-k of a search."""
    d = e.documents(spark, sf_dir).withColumnRenamed("doc_id", "event_id")
    names = b.links(spark, sf_dir).select("event_id", F.col("group").alias("name")).distinct()
    return retrieval.search_events(d, names, ["title", "content"], ["stupid", "License"], [F.desc("event_id")], 15).select("event_id", "partners")


def sample_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impact levels and sign flags of order links."""
    r = b.links(spark, sf_dir).select("event_id", "entity", "score")
    sign = F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("score") - 0.5)
    return r.select("event_id", "entity", "score", samples.impact_level(F.col("score")).alias("level"), samples.sign_flag(sign).alias("up"))


QUERIES = {
    f.__name__: f
    for f in (list_blocks, page_times, nested_listing, event_listing, quote_lines, series_cache, failure_kinds, top_failures, source_health, address_parts, page_metas, cleaned_texts, event_search, sample_impact)
}

_I = "event_id"
_TWO = "lpad(CAST({0} AS VARCHAR), 2, '0')"
_MD = f"{_TWO.format('event_id % 12 + 1')} || '-' || {_TWO.format('event_id % 28 + 1')}"
_CLOCK = f"{_TWO.format('event_id % 24')} || ':' || {_TWO.format('event_id % 60')}"
_YEAR = f"CASE WHEN CAST('2024-' || {_MD} || ' ' || {_CLOCK} || ':00' AS TIMESTAMP) > TIMESTAMP '2024-03-06 10:20:30' THEN '2023-' ELSE '2024-' END || {_MD} || ' ' || {_CLOCK} || ':00'"
_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

ORACLE_SQL = {
    "list_blocks": f"""WITH x AS (SELECT page_id, unnest(bs) AS blk, unnest(range(len(bs))) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li><a href=.*?</li>') AS bs FROM pages)), y AS (SELECT page_id, i, trim(regexp_extract(blk, 'href="([^"]*)"', 1)) AS href, {e._plain("regexp_extract(blk, '(?s)<a [^>]*>(.*?)</a>', 1)")} AS title FROM x)
SELECT page_id, href, title FROM y WHERE title <> '' QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY i) = 1""",
    "page_times": f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN {_STAMP.format("TIMESTAMP '2024-03-05 10:20:30' - to_minutes(event_id % 60)")} WHEN 1 THEN {_STAMP.format("TIMESTAMP '2024-03-05 10:20:30' - to_hours(event_id % 24)")} WHEN 2 THEN {_YEAR} WHEN 3 THEN '2023-' || {_MD} || ' ' || {_CLOCK} || ':00' ELSE '2024-03-05 10:20:30' END AS relative,
  CASE WHEN event_id % 2 = 0 THEN {_YEAR} ELSE '2024-03-05 10:20:30' END AS yearless, CASE WHEN event_id % 3 = 0 THEN '2022-' || {_MD} || ' 00:00:00' ELSE '2024-03-05 10:20:30' END AS or_now, '2023-' || {_MD} || CASE WHEN event_id % 2 = 0 THEN ' ' || {_CLOCK} || ':00' ELSE ' 00:00:00' END AS strict FROM events""",
    "nested_listing": "SELECT CAST(l_linenumber AS VARCHAR) AS no, l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1, 2",
    "event_listing": "SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'by ' || event_type END AS title FROM events",
    "quote_lines": f"""WITH {b.PRICES_SQL}, x AS (SELECT entity, strftime(day, '%Y-%m-%d') AS day, CASE WHEN day(day) <> 13 THEN close END AS close FROM px), y AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY entity ORDER BY day), 0) - 1 AS r FROM x) SELECT entity, day, close, floor(r * 1e6 + 0.5) / 1e6 AS daily_return FROM y""",
    "series_cache": "SELECT event_type AS key, 's:' || event_type AS source, strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) AS DOUBLE) AS value FROM events WHERE strftime(ts, '%d') <> '07' GROUP BY ALL",
    "failure_kinds": "SELECT event_id, CASE WHEN event_id % 7 = 0 AND event_id % 3 = 0 THEN 'empty_data' ELSE ['', 'network', 'network', 'parse', 'unknown', 'parse', 'unknown'][event_id % 7 + 1] END AS kind FROM events",
    "top_failures": "SELECT event_type AS collector, CASE WHEN event_id % 4 = 0 THEN 'network' ELSE 'parse' END AS failure_category, count(*) AS n FROM events WHERE event_id % 3 <> 0 GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 5",
    "source_health": """WITH u AS (SELECT DISTINCT user_id AS u FROM events), s AS (SELECT u, u % 4 AS n, CASE WHEN u % 5 = 0 THEN 0 ELSE 100 END AS t FROM u WHERE u % 3 <> 0), r AS (SELECT u, CASE WHEN u % 4 = 0 THEN 'network' ELSE '' END AS c FROM u WHERE u % 2 = 0),
j AS (SELECT coalesce(s.u, r.u) AS u, coalesce(n, 0) AS n, coalesce(t, 0) AS t, c, s.u IS NOT NULL AS old FROM s FULL JOIN r ON s.u = r.u), k AS (SELECT *, CASE WHEN c IS NULL THEN n WHEN c <> '' THEN n + 1 ELSE 0 END AS m FROM j)
SELECT 'u' || u AS source, m AS consecutive_failures, CASE WHEN c IS NULL THEN t WHEN c <> '' AND m >= 3 THEN 2800 ELSE 0 END AS skip_until_ts, CASE WHEN c IS NOT NULL THEN c ELSE 'old' END AS last_failure_category, CASE WHEN c IS NOT NULL THEN 'e' ELSE '' END AS last_error FROM k""",
    "address_parts": """WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'A' || o_orderkey END AS item, CASE WHEN o_orderkey % 5 = 0 THEN '2024 10' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders)
SELECT k AS o_orderkey, CAST(k AS VARCHAR) AS code, item, CASE WHEN item <> '' AND length(d) = 10 THEN 'http://f/finalpage/' || d || '/' || item || '.PDF http://f/finalpage/' || d || '/' || item || '.pdf' ELSE '' END AS files, CASE WHEN k % 2 = 0 THEN k END AS state, CASE WHEN k % 2 = 0 THEN '{"x":1}' ELSE '[]' END AS json FROM o""",
    "page_metas": f"SELECT page_id, url AS title, '2024' AS day, md5({e._plain('html')}) AS text FROM pages",
    "cleaned_texts": """SELECT doc_id, 'abc' || chr(9) || 'd' || chr(10) || 'e' || regexp_replace(substr(text, 1, 50), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS text, CASE WHEN doc_id % 4 < 3 THEN CAST(make_timestamp((1704067200 + (doc_id % 365) * 86400) * 1000000) AS DATE) END AS date,
  CASE WHEN doc_id % 2 = 0 THEN CAST(CAST(make_timestamp((1704067200 + (doc_id % 365) * 86400) * 1000000) AS DATE) AS TIMESTAMP) + INTERVAL '7 hours 8 minutes' END AS time, CASE doc_id % 3 WHEN 0 THEN 'p+q' WHEN 1 THEN 'p+q+r+s' ELSE '' END AS items FROM documents""",
    "event_search": f"""WITH {e._DOCS}, {b.LINKS_SQL}, h AS (SELECT doc_id AS event_id FROM docs WHERE title ILIKE '%stupid%' OR content ILIKE '%stupid%' OR title ILIKE '%License%' OR content ILIKE '%License%' ORDER BY doc_id DESC LIMIT 15)
SELECT event_id, coalesce((SELECT string_agg(DISTINCT "group", ', ' ORDER BY "group") FROM links WHERE links.event_id = h.event_id), '') AS partners FROM h""",
    "sample_impact": f"WITH {b.LINKS_SQL} SELECT event_id, entity, score, CASE WHEN score >= 0.8 THEN 'S' WHEN score >= 0.6 THEN 'A' WHEN score >= 0.4 THEN 'B' ELSE 'C' END AS level, CASE WHEN event_id % 3 <> 0 THEN score - 0.5 > 0 END AS up FROM links",
}
