"""Queries on stored documents, merges, relations, company master data, code and number scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric
from ..functions import text as T
from ..operators import companies, documents, master, relations, upsert
from . import bindings as b
from . import event_queries as e
from .event_queries import _any, _q

TODAY = "2024-10-01"


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as collected: times in several formats, some bad, some urls blank, control characters."""
    d = e.documents(spark, sf_dir)
    i = F.col("doc_id")
    day = F.date_format("publish_time", "yyyy-MM-dd")
    time = F.when(i % 4 == 0, F.concat(day, F.lit(" 08:30:15"))).when(i % 4 == 1, F.concat(day, F.lit(" 08:30"))).when(i % 4 == 2, day).otherwise(F.concat(F.lit("on "), day))
    return d.select(
        i.alias("id"), "source", F.concat(F.when(i % 7 == 0, F.lit("\x01")).otherwise(F.lit("")), F.col("title")).alias("title"), F.when(i % 11 == 0, F.lit(" ")).otherwise(F.col("content")).alias("content"), time.alias("publish_time"),
        F.when(i % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), (F.floor(i / 2) * 2).cast("string"))).alias("url"), F.lit("x").alias("symbol_or_subject"),
    )


def document_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents (the first half) after a batch of all: cleaned, none of the future, the last of each url."""
    raw = documents.with_url(_raw(spark, sf_dir))
    columns = ["source", "source_type", "title", "content", "publish_time", "url", "symbol_or_subject", "content_hash"]
    old = upsert.last_wins(documents.prepared(raw.filter("id % 2 = 0 AND id % 3 = 0"), "2100-01-01"), ["url"], "id").select(*columns)
    found = documents.upserted(old, raw, TODAY, "id")
    return found.withColumns({"title": F.md5(F.col("title").cast("binary")), "content": F.md5(F.col("content").cast("binary")), "publish_time": F.date_format("publish_time", "yyyy-MM-dd HH:mm:ss")})


def history_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected documents by url, the last of each, with made-up urls."""
    return documents.deduplicated(_raw(spark, sf_dir), "id").select("id", "url")


def history_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of collected documents as text, and whether they lie in a range with and without its last day."""
    t, first, last = F.col("publish_time"), "2024-03-01", "2024-09-10"
    return _raw(spark, sf_dir).select("id", documents.history_date(t).alias("date"), documents.in_range(t, first, last).alias("inclusive"), documents.in_range(t, first, last, False).alias("exclusive"))


def content_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with collapsed white space, written over those of every third document."""
    d = _raw(spark, sf_dir).select("id", "title", "content")
    new = documents.content_update(d.filter("id % 3 = 0"))
    return upsert.content_updates(d, new, "id", "content").select("id", F.md5(F.col("content").cast("binary")).alias("content"))


def longer_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose content another text replaces where that is longer."""
    d = e.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "content")
    bodies = e.documents(spark, sf_dir).select((F.col("doc_id") + 1).alias("id"), F.col("title").alias("body"))
    return documents.longer_body(d, bodies, "id").select("id", F.md5(F.col("content").cast("binary")).alias("content"))


def backfill_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after the twentieth with short bodies or only a title: the second of three shards."""
    d = e.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "title", "content", "source")
    return documents.backfill_candidates(d, 400, 3, 1, 20).select("id", "source")


def source_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 11 to 30 of the latest documents of one source: a page."""
    return documents.page_of_source(e.documents(spark, sf_dir), "src1", 10, 20).select("doc_id", "url")


def row_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the number of their batch of 500 rows."""
    return documents.batches(b.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 500)


def _merge(spark: SparkSession, sf_dir: str):
    d = b.table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    docs = d.filter("doc_id % 10 <> 9").select(i.alias("id"), F.concat(F.lit("doc://"), i).alias("url"))
    stage = d.filter("doc_id % 2 = 0").select(F.concat(F.lit("doc://"), i).alias("raw_document_url"), F.concat(F.lit("k"), i % 7).alias("dedup_key"), (i % 4).cast("string").alias("duplicate_group_size"), F.when(i % 3 == 0, "true").otherwise("false").alias("is_event"), F.lit("r").alias("filter_reason"), F.lit("v").alias("evidence"), F.when(i % 5 == 0, "").otherwise((i % 9).cast("string")).alias("score_hint"))
    old = docs.filter("id % 3 <> 1").select(F.col("id").alias("raw_document_id"), F.lit("old").alias("dedup_key"), F.lit(1).alias("duplicate_group_size"), (F.col("id") % 4 < 2).alias("is_event"), F.lit("o").alias("filter_reason"), F.lit("o").alias("evidence"), F.lit(7).alias("score_hint"))
    return d, docs, stage, old


def candidate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored candidates after a stage of text columns."""
    _, docs, stage, old = _merge(spark, sf_dir)
    return documents.candidate_merge(stage, docs, old).withColumns({c: F.col(c).cast("long") for c in ("duplicate_group_size", "score_hint")})


def structured_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events after a stage: blanks take defaults, demoted events go."""
    d, docs, stage, old = _merge(spark, sf_dir)
    i = F.col("doc_id")
    merged = documents.candidate_merge(stage, docs, old)
    blank = F.when(i % 4 == 0, "").when(i % 4 == 2, " ")
    events = d.filter("doc_id % 2 = 0").select(F.concat(F.lit("doc://"), i).alias("raw_text_ref"), F.concat(F.lit("E"), i).alias("event_id"), F.coalesce(blank, (i % 50).cast("string")).alias("novelty_score"), F.coalesce(blank, F.lit("text")).alias("source_type"), F.coalesce(blank, F.lit("0.25")).alias("classification_confidence"), F.lit("x1").alias("heat_score"), F.lit("2024-02-03").alias("event_date"))
    stored = docs.filter("id % 3 = 2").select(F.col("id").alias("raw_document_id"), F.lit("r").alias("raw_text_ref"), F.lit("old").alias("event_id"), F.lit(1).alias("novelty_score"), F.lit("s").alias("source_type"), F.lit(0.9).alias("classification_confidence"), F.lit(2).alias("heat_score"), F.lit("2020-01-01").cast("date").alias("event_date"))
    found = documents.structured_merge(events, docs, stage, merged, stored)
    return found.withColumns({c: F.col(c).cast("long") for c in ("novelty_score", "heat_score")})


def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a range of days with their year: what a yearly export writes."""
    o = b.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return documents.yearly(o, "day", "1995-03-01", "1997-02-28").withColumn("year", F.col("year").cast("long"))


def relations_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of suppliers after a load: names resolved, undirected ones turned, strengths clamped, evidence as JSON."""
    s = b.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("S"), "s_suppkey").alias("code"), F.col("s_name").alias("name"))
    l = b.table(spark, sf_dir, "lineitem").filter("l_linenumber = 1")  # noqa: E741
    k, a, t = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_partkey") % 60
    seed = l.select(
        k.alias("seq"), F.when(k % 3 == 0, F.concat(F.lit("s"), a)).otherwise("").alias("source_ts_code"), F.when(k % 3 != 0, F.format_string("Supplier#%09d", a)).otherwise("none").alias("source_company_name"), F.concat(F.lit(" S"), t).alias("target_ts_code"), F.lit("").alias("target_company_name"),
        F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("t"), k % 4)).alias("relation_type"), F.when(k % 4 == 0, "x").when(k % 4 == 1, "1.5").when(k % 4 == 2, "").otherwise("0.123").alias("relation_strength"), F.when(k % 2 == 0, "Directed").otherwise("").alias("direction"),
        F.lit("note").alias("evidence_note"), F.when(k % 5 == 0, F.lit("src")).alias("data_source"), F.when(k % 7 == 0, "是").when(k % 7 == 1, "0").otherwise("?").alias("same_industry_flag"),
    )
    old = s.select(F.col("id").alias("source"), (F.col("id") + 1).alias("target"), F.lit("t1").alias("relation_type"), F.lit(0.9).alias("strength"), F.lit("directed").alias("direction"), F.lit("{}").alias("evidence"), (F.col("id") % 2 == 0).alias("is_manual"))
    return relations.loaded(old, seed, s, "seq")


def company_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies named by documents: code, names and industry by patterns, folded in order."""
    d = e.documents(spark, sf_dir).withColumn("symbol_or_subject", F.when(F.col("doc_id") % 3 == 0, F.lpad((F.col("doc_id") % 40 + 600000).cast("string"), 6, "0")).otherwise("none"))
    rules = (("north", ("ung ", "heit")), ("south", ("ción",)), ("west", ("eau",)))
    found = companies.extracted(d, "^[0-9]{6}$", "([0-9]{6})", "([A-Z][a-z]+)tion", "^([A-Za-z]{4,8}) ", "^([A-Z][a-z]+ [a-z]+)", "heit", rules, "other")
    rows = found.withColumns({"company_name": F.coalesce(F.nullif("short_name", F.lit("")), F.nullif("full_name", F.lit("")), F.col("code")), "listing": companies.listing(F.col("code")), "tags": companies.ordered_tags(F.col("industry"), F.col("short_name"), F.col("full_name"))})
    out = companies.folded(rows, "listing", "doc_id", ["company_name", "full_name"], ["industry"], "tags", "other")
    return out.withColumn("tags", F.array_join("tags", "|"))


def company_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with names and states from a hand-made list over them, which also adds some."""
    s = b.table(spark, sf_dir, "supplier")
    rows = s.select(F.concat(F.lit("S"), "s_suppkey").alias("code"), F.col("s_name").alias("name"), F.lit("a").alias("state"))
    o = s.filter("s_suppkey % 3 = 0").select(F.concat(F.lit("S"), F.col("s_suppkey") * 2).alias("code"), F.when(F.col("s_suppkey") % 2 == 0, "").otherwise("hand").alias("name"), F.lit("b").alias("state"))
    return companies.overridden(rows, o, "code")


def company_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of suppliers, each field from the first source that has it."""
    s = b.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.lit("").alias("region"))
    c = b.table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    n = b.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("region"))
    fields = {"name": ["seed.name", "base.name"], "region": ["base.region", "geo.region", "seed.segment"], "segment": ["seed.segment"]}
    return companies.first_filled_of(s, "k", {"seed": c, "geo": n}, fields)


def filled_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of suppliers merged, with other as empty: once the new side wins, once the old."""
    s = b.table(spark, sf_dir, "supplier")
    old = s.filter("s_suppkey % 4 <> 3").select(F.col("s_suppkey").alias("k"), F.when(F.col("s_suppkey") % 2 == 0, "other").otherwise("old").alias("v"))
    new = s.filter("s_suppkey % 5 <> 4").select(F.col("s_suppkey").alias("k"), F.when(F.col("s_suppkey") % 3 == 0, "").otherwise("new").alias("v"))
    seeds = upsert.filled_from(old, new, "k", ["v"], ("", "other"))
    kept = upsert.filled_from(old, new, "k", ["v"], ("", "other"), "old")
    return seeds.withColumnRenamed("v", "new_first").join(kept.withColumnRenamed("v", "old_first"), "k")


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes made of customers' and orders' keys with their exchanges, suffixes, listings and symbols."""
    c = b.table(spark, sf_dir, "orders").select("o_orderkey", F.lpad(((F.col("o_orderkey") * 7919 + F.col("o_custkey") * 104729) % 1000000).cast("string"), 6, "0").alias("c"))
    x = F.col("c")
    given = F.when(F.col("o_orderkey") % 3 == 0, F.concat(x, F.lit(".sz"))).when(F.col("o_orderkey") % 3 == 1, x).otherwise(F.concat(F.lit("a"), x))
    quotes = T.quote_symbols(companies.listing(x))
    return c.select("o_orderkey", companies.exchange(x).alias("exchange"), companies.suffix(x).alias("suffix"), companies.listing(x).alias("listing"), companies.listing(x, True).alias("strict"), companies.symbol_listing(given).alias("symbol"), companies.exchange_of_listing(companies.listing(x)).alias("of_listing"), companies.company_type(companies.exchange(x), F.when(F.col("o_orderkey") % 9 == 0, "given")).alias("kind"), quotes["prefixed"].alias("prefixed"), quotes["numbered"].alias("numbered"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of customers from province, city and area, and from addresses."""
    c = b.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    p = F.when(k % 4 == 0, "").when(k % 4 == 1, "广东").otherwise("P1")
    city = F.when(k % 3 == 0, "").when(k % 3 == 1, "P1").otherwise("C2")
    address = F.element_at(F.array(*[F.lit(x) for x in ("广东省深圳市南山区", "上海市浦东新区", "中国江苏省南京市", "内蒙古自治区包头市", "somewhere 12345678 北京", "", "北京北京市海淀")]), (k % 7 + 1).cast("int"))
    return c.select("c_custkey", companies.region(F.lit("area"), p, city).alias("region"), companies.region(F.when(k % 5 == 0, "A").otherwise(""), p, city, True).alias("area_first"), companies.region_of_address(address).alias("address"), F.array_join(companies.concept_tags(F.lit("l1"), F.when(k % 2 == 0, "芯片").otherwise("l1"), F.when(k % 3 == 0, "x银行")), "|").alias("tags"), master.state_owned(F.when(k % 3 == 0, "由国资委管理"), F.lit("x")).alias("state_owned"))


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, flags and amounts of orders as text, read leniently."""
    o = b.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 0, "").when(k % 5 == 1, "1,234.50").when(k % 5 == 2, "NaN").when(k % 5 == 3, "n/a").otherwise(F.concat(F.lit(" "), k, F.lit(".9 ")))
    flag = F.element_at(F.array(*[F.lit(x) for x in ("是", "No", " T ", "0", "?", "")]), (k % 6 + 1).cast("int"))
    unit = F.element_at(F.array(*[F.lit(x) for x in ("万元", "亿", "千万元", "港元", "x")]), (k % 5 + 1).cast("int"))
    amount = F.concat(F.lit("约 "), (k % 97).cast("string"), unit, F.lit("，另 3万元"))
    return o.select("o_orderkey", numeric.lenient_double(text).alias("number"), numeric.lenient_int(text, -1).cast("long").alias("whole"), numeric.tri_state(flag).alias("flag"), numeric.clamped(F.col("o_totalprice") / 400000, 0.1, 0.9, 0.5).alias("clamped"), T.amount_yuan(amount).alias("amount"), T.amount_log(amount).alias("log_amount"))


def staged_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns of orders cast with defaults."""
    k = F.col("o_orderkey")
    rows = b.table(spark, sf_dir, "orders").select(k.cast("string").alias("k"), F.when(k % 3 == 0, " ").when(k % 3 == 1, "x").otherwise((k % 100).cast("string")).alias("n"), F.when(k % 2 == 0, "").otherwise("t").alias("t"))
    return upsert.staged(rows, {"k": "bigint", "n": "bigint"}, {"n": 50, "t": "none"})


def normalized_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by a shared code, the first of each, names without white space, tags merged, industries updated."""
    c = b.table(spark, sf_dir, "customer").select((F.col("c_custkey") % 100).alias("code"), "c_custkey", companies.bare_name(F.concat(F.lit(" A b "), "c_mktsegment")).alias("name"), F.array("c_mktsegment", F.lit("x")).alias("tags"), F.lit("old").alias("industry"))
    first = upsert.first_wins(c, ["code"], "c_custkey")
    new = b.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("code"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(" ").alias("industry"))
    out = master.with_industry(first, new, "code")
    return out.select("code", "c_custkey", "name", F.array_join(master.merged_tags(F.array(F.lit("x"), F.lit("y")), F.col("tags"), 3), "|").alias("tags"), "industry")


QUERIES = {
    f.__name__: f
    for f in (document_upsert, history_dedup, history_windows, content_updates, longer_bodies, backfill_candidates, source_page, row_batches, candidate_merge, structured_merge, yearly_orders, relations_load, company_records, company_overrides, company_profiles, filled_companies, codes, regions, numbers, staged_casts, normalized_companies)
}

_DAY = "strftime(publish_time, '%Y-%m-%d')"
_RAW = f"""WITH {e._DOCS}, raw AS (SELECT doc_id AS id, source, CASE WHEN doc_id % 7 = 0 THEN chr(1) ELSE '' END || title AS title, CASE WHEN doc_id % 11 = 0 THEN ' ' ELSE content END AS content,
  CASE doc_id % 4 WHEN 0 THEN {_DAY} || ' 08:30:15' WHEN 1 THEN {_DAY} || ' 08:30' WHEN 2 THEN {_DAY} ELSE 'on ' || {_DAY} END AS pt, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'u' || (doc_id // 2 * 2) END AS url, 'x' AS symbol_or_subject FROM docs),
ur AS (SELECT * EXCLUDE (url), CASE WHEN url <> '' THEN url ELSE 'local://history/' || source || '/' || md5(title || '::' || pt) END AS url FROM raw)"""
_CLEAN = "regexp_replace({0}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')"
_PRE = f"""pr AS (SELECT *, md5(title || '::' || content) AS content_hash, 'text_source' AS source_type FROM (SELECT id, source, url, symbol_or_subject, t AS title, CASE WHEN c <> '' THEN c WHEN t <> '' THEN t ELSE '(empty)' END AS content,
  CASE WHEN id % 4 = 0 THEN pt WHEN id % 4 = 1 THEN pt || ':00' WHEN id % 4 = 2 THEN pt || ' 00:00:00' ELSE '1970-01-01 00:00:00' END AS publish_time FROM (SELECT *, trim({_CLEAN.format('title')}) AS t, trim({_CLEAN.format('content')}) AS c FROM ur)))"""
_MERGE = """WITH docs AS (SELECT doc_id AS id FROM documents WHERE doc_id % 10 <> 9),
new AS (SELECT id AS raw_document_id, 'k' || (id % 7) AS dedup_key, id % 4 AS duplicate_group_size, id % 3 = 0 AS is_event, 'r' AS filter_reason, 'v' AS evidence, CASE WHEN id % 5 = 0 THEN NULL ELSE id % 9 END AS score_hint FROM docs WHERE id % 2 = 0),
mg AS (SELECT * FROM new UNION ALL SELECT id, 'old', 1, id % 4 < 2, 'o', 'o', 7 FROM docs WHERE id % 3 <> 1 AND id % 2 <> 0)"""
_EXCHANGE = "CASE " + " ".join(f"WHEN substr(c, 1, 3) IN ({', '.join(map(_q, p))}) THEN {_q(k)}" for k, p in companies.EXCHANGES.items()) + " ELSE '' END"
_RULES = (("north", ("ung ", "heit")), ("south", ("ción",)), ("west", ("eau",)))

ORACLE_SQL = {
    "document_upsert": f"""{_RAW}, {_PRE}, old AS (SELECT * FROM pr WHERE id % 2 = 0 AND id % 3 = 0 QUALIFY row_number() OVER (PARTITION BY url ORDER BY id DESC) = 1),
nw AS (SELECT * FROM pr WHERE CAST(publish_time AS TIMESTAMP) < TIMESTAMP '2024-10-02' QUALIFY row_number() OVER (PARTITION BY url ORDER BY id DESC) = 1),
al AS (SELECT * FROM nw UNION ALL SELECT * FROM old WHERE url NOT IN (SELECT url FROM nw)) SELECT source, source_type, md5(title) AS title, md5(content) AS content, publish_time, url, symbol_or_subject, content_hash FROM al""",
    "history_dedup": f"{_RAW} SELECT max(id) AS id, url FROM ur GROUP BY url",
    "history_windows": f"{_RAW}, h AS (SELECT id, CASE WHEN id % 4 = 3 THEN substr(pt, 1, 10) ELSE substr(pt, 1, 10) END AS date FROM raw) SELECT id, date, date >= '2024-03-01' AND date <= '2024-09-10' AS inclusive, date >= '2024-03-01' AND date < '2024-09-10' AS exclusive FROM h",
    "content_updates": f"{_RAW} SELECT id, md5(CASE WHEN id % 3 = 0 THEN trim(regexp_replace(content, '\\s+', ' ', 'g')) ELSE content END) AS content FROM raw",
    "longer_bodies": f"WITH {e._DOCS} SELECT a.doc_id AS id, md5(CASE WHEN length(b.title) > length(a.content) THEN b.title ELSE a.content END) AS content FROM docs a LEFT JOIN docs b ON a.doc_id = b.doc_id + 1",
    "backfill_candidates": f"WITH {e._DOCS}, n AS (SELECT doc_id AS id, source, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM docs WHERE doc_id > 20 AND (length(trim(content)) < 400 OR trim(content) = trim(title))) SELECT id, source FROM n WHERE rn % 3 = 1",
    "source_page": f"WITH {e._DOCS} SELECT doc_id, 'doc://' || doc_id AS url FROM docs WHERE source = 'src1' ORDER BY publish_time DESC, 'doc://' || doc_id LIMIT 20 OFFSET 10",
    "row_batches": "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS batch FROM orders",
    "candidate_merge": f"{_MERGE} SELECT * FROM mg",
    "structured_merge": f"""{_MERGE}, ev AS (SELECT id AS raw_document_id, 'doc://' || id AS raw_text_ref, 'E' || id AS event_id, 50 AS novelty_score, '其他来源' AS source_type, 0.5 AS classification_confidence, NULL AS heat_score, DATE '2024-02-03' AS event_date FROM docs WHERE id % 2 = 0),
al AS (SELECT * FROM ev UNION ALL SELECT id, 'r', 'old', 1, 's', 0.9, 2, DATE '2020-01-01' FROM docs WHERE id % 3 = 2 AND id % 2 <> 0) SELECT * FROM al WHERE NOT (raw_document_id % 2 = 0 AND raw_document_id % 3 <> 0)""",
    "yearly_orders": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS year FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN '1995-03-01' AND '1997-02-28'",
    "relations_load": """WITH l AS (SELECT l_orderkey AS k, l_suppkey AS a, l_partkey % 60 AS t FROM lineitem WHERE l_linenumber = 1),
x AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'directed' ELSE 'undirected' END AS direction, CASE k % 4 WHEN 1 THEN 1.0 WHEN 3 THEN 0.123 ELSE 0.5 END AS strength FROM l JOIN supplier ON t = s_suppkey WHERE k % 10 <> 0 AND a IN (SELECT s_suppkey FROM supplier)),
y AS (SELECT *, CASE WHEN direction = 'undirected' AND a > t THEN t ELSE a END AS source, CASE WHEN direction = 'undirected' AND a > t THEN a ELSE t END AS target, 't' || (k % 4) AS relation_type FROM x),
z AS (SELECT source, target, relation_type, strength, direction, '{"evidence_note":"note","source_ts_code":"S' || source || '","target_ts_code":"S' || target || '","source_company_name":"' || printf('Supplier#%09d', source) || '","target_company_name":"' || printf('Supplier#%09d', target) || '"'
  || CASE WHEN k % 5 = 0 THEN ',"data_source":"src"' ELSE '' END || CASE k % 7 WHEN 0 THEN ',"same_industry_flag":true' WHEN 1 THEN ',"same_industry_flag":false' ELSE '' END || '}' AS evidence, true AS is_manual FROM y QUALIFY row_number() OVER (PARTITION BY source, target, relation_type ORDER BY k DESC) = 1)
SELECT * FROM z UNION ALL SELECT s_suppkey, s_suppkey + 1, 't1', 0.9, 'directed', '{}', false FROM supplier WHERE s_suppkey % 2 <> 0 AND NOT EXISTS (SELECT 1 FROM z WHERE source = s_suppkey AND target = s_suppkey + 1 AND relation_type = 't1')""",
    "company_records": f"""WITH {e._DOCS}, d AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN lpad(CAST(doc_id % 40 + 600000 AS VARCHAR), 6, '0') ELSE 'none' END AS sym, trim(title) AS t, trim(content) AS c FROM docs),
x AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN sym ELSE regexp_extract(c, '([0-9]{{6}})', 1) END AS code FROM d),
y AS (SELECT *, regexp_replace(coalesce(nullif(regexp_extract(c, '([A-Z][a-z]+)tion', 1), ''), regexp_extract(t, '^([A-Za-z]{{4,8}}) ', 1)), '\\s+', '', 'g') AS short_name, trim(coalesce(nullif(regexp_extract(t, '^([A-Z][a-z]+ [a-z]+)', 1), ''), CASE WHEN contains(split_part(c, '；', 1), 'heit') THEN split_part(c, '；', 1) END, '')) AS full_name,
  CASE {' '.join(f"WHEN {_any('ft2', ks)} THEN {_q(k)}" for k, ks in _RULES)} ELSE 'other' END AS industry FROM (SELECT *, source || ' ' || title || ' ' || content AS ft2 FROM x) WHERE regexp_matches(code, '^[0-9]{{6}}$')),
z AS (SELECT *, coalesce(nullif(short_name, ''), nullif(full_name, ''), code) AS company_name, {_EXCHANGE.replace('substr(c,', 'substr(code,')} AS ex, list_filter([industry, short_name, full_name], lambda v: v <> '') AS tags FROM y),
w AS (SELECT *, CASE ex WHEN 'SSE' THEN code || '.SH' WHEN 'SZSE' THEN code || '.SZ' WHEN 'BSE' THEN code || '.BJ' ELSE code END AS listing FROM z),
g AS (SELECT listing, arg_min(company_name, CASE WHEN company_name <> '' THEN doc_id END) AS company_name, coalesce(arg_min(full_name, CASE WHEN full_name <> '' THEN doc_id END), '') AS full_name, coalesce(arg_min(industry, CASE WHEN industry <> 'other' THEN doc_id END), 'other') AS industry, flatten(list(tags ORDER BY doc_id)) AS tags FROM w GROUP BY 1)
SELECT listing, company_name, full_name, industry, array_to_string(list_filter(tags, lambda v, i: list_position(tags, v) = i), '|') AS tags FROM g""",
    "company_overrides": """WITH a AS (SELECT 'S' || s_suppkey AS code, s_name AS name, 'a' AS state FROM supplier), o AS (SELECT 'S' || (s_suppkey * 2) AS code, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'hand' END AS name, 'b' AS state FROM supplier WHERE s_suppkey % 3 = 0)
SELECT coalesce(a.code, o.code) AS code, coalesce(nullif(o.name, ''), a.name, o.name) AS name, coalesce(o.state, a.state) AS state FROM a FULL JOIN o ON a.code = o.code""",
    "company_profiles": """SELECT s_suppkey AS k, coalesce(c_name, s_name) AS name, coalesce(n_name, c_mktsegment, '') AS region, coalesce(c_mktsegment, '') AS segment FROM supplier LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON c_custkey = s_suppkey LEFT JOIN nation ON n_nationkey = s_suppkey""",
    "filled_companies": """WITH o AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'other' ELSE 'old' END AS v FROM supplier WHERE s_suppkey % 4 <> 3), n AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'new' END AS v FROM supplier WHERE s_suppkey % 5 <> 4)
SELECT coalesce(o.k, n.k) AS k, coalesce(CASE WHEN n.v NOT IN ('', 'other') THEN n.v END, o.v, n.v) AS new_first, coalesce(CASE WHEN o.v NOT IN ('', 'other') THEN o.v END, n.v, o.v) AS old_first FROM o FULL JOIN n ON o.k = n.k""",
    "codes": f"""WITH a AS (SELECT o_orderkey, lpad(CAST((o_orderkey * 7919 + o_custkey * 104729) % 1000000 AS VARCHAR), 6, '0') AS c FROM orders), x AS (SELECT *, {_EXCHANGE} AS exchange FROM a),
y AS (SELECT *, CASE exchange WHEN 'SSE' THEN 'SH' WHEN 'SZSE' THEN 'SZ' WHEN 'BSE' THEN 'BJ' ELSE '' END AS suffix FROM x), z AS (SELECT *, CASE WHEN suffix <> '' THEN c || '.' || suffix ELSE c END AS listing FROM y)
SELECT o_orderkey, exchange, suffix, listing, CASE WHEN suffix <> '' THEN listing ELSE '' END AS strict, CASE o_orderkey % 3 WHEN 0 THEN c || '.SZ' WHEN 1 THEN CASE WHEN substr(c, 1, 1) IN ('5', '6', '9') THEN c || '.SH' WHEN substr(c, 1, 1) IN ('0', '2', '3') THEN c || '.SZ' WHEN substr(c, 1, 1) IN ('4', '8') THEN c || '.BJ' ELSE '' END ELSE '' END AS symbol, exchange AS of_listing,
  CASE WHEN o_orderkey % 9 = 0 THEN 'given' WHEN exchange = 'SSE' THEN '沪市A股' WHEN exchange = 'SZSE' THEN '深市A股' WHEN exchange = 'BSE' THEN '北交所' ELSE 'A股' END AS kind, CASE WHEN suffix <> '' THEN lower(suffix) || c ELSE c || c END AS prefixed, CASE WHEN suffix = 'SH' THEN '1.' ELSE '0.' END || c AS numbered FROM z""",
    "regions": """WITH x AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '广东' ELSE 'P1' END AS p, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'P1' ELSE 'C2' END AS c FROM customer)
SELECT c_custkey, coalesce(CASE WHEN p <> c THEN p || '-' || c END, p, c, 'area') AS region, coalesce(CASE WHEN c_custkey % 5 = 0 THEN 'A' END, CASE WHEN p <> c THEN p || '-' || c END, p, c) AS area_first, ['广东-深圳', '上海', '江苏-南京', '内蒙古-包头', '', '', '北京'][c_custkey % 7 + 1] AS address,
  'l1' || CASE WHEN c_custkey % 2 = 0 THEN '|芯片' ELSE '' END || CASE WHEN c_custkey % 3 = 0 THEN '|银行' ELSE '' END AS tags, c_custkey % 3 = 0 AS state_owned FROM x""",
    "numbers": """WITH x AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderkey % 97 AS v, [1e4, 1e8, 1e8, 0.92, NULL][o_orderkey % 5 + 1] AS u FROM orders), y AS (SELECT *, CAST(greatest(CAST(3e4 AS DOUBLE), coalesce(CAST(v AS DOUBLE) * CAST(u AS DOUBLE), 0)) AS DOUBLE) AS amount FROM x)
SELECT k AS o_orderkey, CASE k % 5 WHEN 1 THEN 1234.5 WHEN 4 THEN k + 0.9::DOUBLE END AS number, CASE k % 5 WHEN 1 THEN 1234 WHEN 4 THEN k ELSE -1 END AS whole, CASE k % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS flag, greatest(0.1::DOUBLE, least(0.9::DOUBLE, p / 400000)) AS clamped, amount, round(log10(amount + 1), 6) AS log_amount FROM y""",
    "staged_casts": "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey % 100 ELSE 50 END AS n, CASE WHEN o_orderkey % 2 = 0 THEN 'none' ELSE 't' END AS t FROM orders",
    "normalized_companies": """WITH f AS (SELECT c_custkey % 100 AS code, min(c_custkey) AS c_custkey, arg_min(c_mktsegment, c_custkey) AS m FROM customer GROUP BY 1)
SELECT code, c_custkey, 'Ab' || m AS name, 'x|y|' || m AS tags, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'old' END AS industry FROM f LEFT JOIN nation ON code = n_nationkey""",
}
