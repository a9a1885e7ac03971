"""Queries on delivery checks, governance of documents, quality reports, panels of changes, study outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.numeric import rounded
from ..operators import cluster_stats, delivery, event_study, graph, panel, quality
from . import bindings as b
from . import event_queries as e
from . import market_queries as m
from .event_queries import _n, _q

PROFILES = [("src1%", "ones"), ("src2%", "twos"), ("%5", "fives")]


#: The given tables in the roles of the delivered ones; both engines read these expressions.
_ROLES = {
    "raw_documents": ("documents", ["source", "md5(text) AS url"]),
    "label_dictionary": ("nation", ["CASE WHEN n_nationkey % 2 = 0 THEN 'event_subject_type' ELSE 'sentiment' END AS label_group", "n_name AS label_value"]),
    "structured_events": ("orders", [f"CASE WHEN o_orderkey % {k + 11} > 0 THEN substr(o_orderpriority, 1, {k % 3 + 1}) END AS {c}" for k, c in enumerate(delivery._EVENT_COLUMNS)]),
    "company_profiles": ("customer", ["c_custkey % 4 AS snapshot_date", "c_mktsegment AS region", "CASE WHEN c_custkey % 3 > 0 THEN 1 END AS list_date", "CASE WHEN c_custkey % 5 > 3 THEN 1 END AS state_owned_flag", "c_nationkey AS employees", "c_acctbal AS total_shares", "CASE WHEN c_acctbal > 0 THEN 1 END AS float_shares", "' ' AS core_products"]),
    "stock_daily_quotes": ("lineitem", ["l_suppkey AS ts_code", "l_quantity AS open", "l_tax AS high", "CASE WHEN l_orderkey % 20 > 0 THEN 1 END AS low", "l_discount AS amount", "CASE WHEN l_partkey % 3 > 0 THEN 1 END AS turnover_rate", "NULL AS adj_factor", "l_discount > 0.095 AS is_limit_up", "l_tax > 0.079 AS is_limit_down", "CASE WHEN l_linenumber < 3 THEN 'sina' ELSE 'other' END AS data_source"]),
    "sentiment_propagation_daily": ("events", ["value AS heat_score", "CASE WHEN value > 60 THEN 1 END AS heat_growth_rate", "user_id AS heat_duration_days", "CASE WHEN value > 90 THEN 1 END AS disagreement_score", "event_type AS sentiment_std"]),
    "company_relations": ("part", ["CASE WHEN p_partkey % 5 = 0 THEN 'directed' ELSE 'undirected' END AS direction", "p_partkey % 7 AS relation_type", "p_size > 5 AS is_manual_override"]),
    "event_company_links": ("lineitem", ["l_orderkey AS structured_event_id", "l_suppkey AS company_id", "CAST(l_linenumber AS DOUBLE) / 8 AS final_link_score"]),
}


def delivery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published checks of all delivered tables, of which one is missing."""
    tables = {role: b.table(spark, sf_dir, t).selectExpr(*c) for role, (t, c) in _ROLES.items()}
    return delivery.delivery_status(tables | {"market_environment_daily": None})


def _delivery_sql() -> str:
    parts, named = [], []
    for role, (t, c) in _ROLES.items():
        named.append(f"{role} AS (SELECT {', '.join(c)} FROM {t})")
    row = lambda area, metric, value, target, status, source: f"SELECT '{area}' AS area, '{metric}' AS metric, CAST({value} AS DOUBLE) AS value, CAST({target} AS DOUBLE) AS target, {status} AS status FROM {source}"
    for role, c in delivery.PUBLISHED.items():
        if role not in _ROLES:
            parts.append(f"SELECT '{role}', 'table_presence', NULL, {c.least}, 'BLOCK'")
            continue
        parts.append(row(role, "row_count", "count(*)", c.least, f"CASE WHEN count(*) >= {c.least} THEN 'OK' ELSE 'BLOCK' END", role))
        rows = role if c.snapshot is None else f"(SELECT * FROM {role} WHERE {c.snapshot} = (SELECT max({c.snapshot}) FROM {role}))"
        shares = {f"{x}_fill": (f"trim(CAST({x} AS VARCHAR)) <> ''", *bounds) for x, bounds in c.fills.items()} | c.shares
        for metric, (condition, ok, warn) in shares.items():
            share = f"count(*) FILTER ({condition}) / count(*)"
            parts.append(row(role, metric, share, ok, f"CASE WHEN {share} >= {ok} THEN 'OK' WHEN {share} >= {warn} THEN 'WARN' ELSE 'BLOCK' END", rows))
        counts = c.counts | ({"latest_snapshot": (f"CASE WHEN count({c.snapshot}) > 0 THEN 1 ELSE 0 END", 1, "blocks")} if c.snapshot else {})
        for metric, (value, bound, kind) in counts.items():
            good = f"{value} <= {bound}" if kind == "most" else f"{value} >= {bound}"
            parts.append(row(role, metric, value, bound, f"CASE WHEN {good} THEN 'OK' ELSE '{'BLOCK' if kind == 'blocks' else 'WARN'}' END", rows))
        for x, group in c.labels.items():
            missed = f"(SELECT r.{x} IN (SELECT label_value FROM label_dictionary WHERE label_group = '{group}') IS NOT TRUE AS miss FROM {role} r)"
            parts.append(row(role, f"{x}_dictionary_miss", "count(*) FILTER (miss)", 0, "CASE WHEN count(*) FILTER (miss) = 0 THEN 'OK' ELSE 'WARN' END", missed))
    return "WITH " + ", ".join(named) + " " + " UNION ALL ".join(parts)


def cluster_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five statistics of each event's cluster and day, from the states of two batches."""
    ev = _cluster_events(spark, sf_dir)
    state, dictionary = None, None
    for batch in (ev.filter("event_id % 3 = 0"), ev.filter("event_id % 3 <> 0")):  # the first batch, and all the rest
        dictionary = cluster_stats.with_new_sources(dictionary, batch)
        state = cluster_stats.merged(state, cluster_stats.state(batch, dictionary, ("good", "flat", "bad")))
    return cluster_stats.refreshed(ev.select("event_id", "cluster", "day"), state).select("event_id", "report_count", "media_coverage_count", "heat_duration_days", "heat_growth_rate", "disagreement_score")


def _cluster_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = b.table(spark, sf_dir, "events")
    key = cluster_stats.cluster_key(F.col("event_type"), (F.col("user_id") % 7).cast("string"), F.lit(None).cast("string"))
    mood = F.when(F.col("value") > 60, "good").when(F.col("value") > 30, "flat").otherwise("bad")
    return d.select("event_id", key.alias("cluster"), F.to_date("ts").alias("day"), F.when(F.col("user_id") % 10 > 0, F.concat(F.lit("s"), (F.col("user_id") % 83).cast("string"))).alias("source"), mood.alias("sentiment"))


_CLUSTER_STATS = """WITH e AS (SELECT event_id, lower(event_type) || '|' || (user_id % 7) || '|' AS cluster, CAST(ts AS DATE) AS day, CASE WHEN user_id % 10 > 0 THEN 's' || (user_id % 83) END AS source, CASE WHEN value > 60 THEN 'good' WHEN value > 30 THEN 'flat' ELSE 'bad' END AS sentiment FROM events),
d AS (SELECT cluster, day, count(*) AS reports, count(*) FILTER (sentiment = 'good') AS p, count(*) FILTER (sentiment = 'flat') AS u, count(*) FILTER (sentiment = 'bad') AS n FROM e GROUP BY 1, 2),
g AS (SELECT cluster, CAST(sum(reports) AS BIGINT) AS report_count, count(*) AS heat_duration_days FROM d GROUP BY 1), s AS (SELECT cluster, count(DISTINCT source) AS media_coverage_count FROM e GROUP BY 1),
x AS (SELECT d.*, (d.reports - b.reports) / (b.reports + 1) AS growth, -(CASE WHEN d.p > 0 THEN d.p / d.reports * ln(d.p / d.reports) ELSE 0 END) - (CASE WHEN d.u > 0 THEN d.u / d.reports * ln(d.u / d.reports) ELSE 0 END) - (CASE WHEN d.n > 0 THEN d.n / d.reports * ln(d.n / d.reports) ELSE 0 END) AS entropy
  FROM d LEFT JOIN d b ON b.cluster = d.cluster AND b.day = d.day - 1)
SELECT event_id, report_count, media_coverage_count, heat_duration_days, coalesce(sign(growth) * floor(abs(growth) * 1e6 + 0.5) / 1e6, 0.0) AS heat_growth_rate, floor(entropy * 1e6 + 0.5) / 1e6 AS disagreement_score
FROM e JOIN g USING (cluster) JOIN s USING (cluster) JOIN x ON x.cluster = e.cluster AND x.day = e.day"""


def delivery_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios and counts of several tables against their bounds, and their presence."""
    d, o, l, c = (b.table(spark, sf_dir, t) for t in ("documents", "orders", "lineitem", "customer"))
    rows = quality.presence({"documents": d, "orders": o, "not_there": None}, {"documents": 1000, "orders": 10, "not_there": 5})
    rows = rows.unionByName(quality.checks(d, "documents", quality.fills({"text": (0.98, 0.9), "lang": (0.999, 0.5)}), {"source_count": (F.countDistinct("source"), 8, "least"), "duplicate_texts": (F.count("text") - F.countDistinct("text"), 0, "most")}))
    rows = rows.unionByName(quality.checks(o, "orders", {"open_ratio": (F.col("o_orderstatus") == "O", 0.9, 0.2)}, {"max_price": (F.max("o_totalprice"), 1e9, "blocks"), "priorities": (F.countDistinct("o_orderpriority"), 5, "blocks")}))
    rows = rows.unionByName(quality.checks(l, "lineitem", {"discounted": (F.col("l_discount") > 0.05, 0.35, 0.15)}, {"symbols": (F.countDistinct("l_suppkey"), 50, "least"), "avg_score": (rounded(F.avg("l_quantity"), 4), 0.35, "least")}))
    latest = quality.latest_snapshot(c.withColumn("snapshot", F.col("c_custkey") % 10), "snapshot")
    return rows.unionByName(quality.checks(latest, "customer", quality.fills({"c_name": (0.8, 0.5)}), {"rows": (F.count(F.lit(1)), 1, "blocks")}))


def dictionary_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' languages and sources, and orders' states, that a dictionary lacks; labels by group."""
    d = b.table(spark, sf_dir, "documents")
    known = d.filter("lang = 'en'").select(F.lit("language").alias("label_group"), F.col("lang").alias("label_value"))
    known = known.unionByName(b.table(spark, sf_dir, "nation").select(F.lit("source").alias("label_group"), F.concat(F.lit("src"), "n_nationkey").alias("label_value"))).distinct()
    groups = quality.checks(known, "dictionary", {}, {"label_groups": (F.countDistinct("label_group"), 10, "blocks")})
    return quality.dictionary_checks(d, "documents", {"lang": "language", "source": "source"}, known).unionByName(groups)


def _window() -> Column:
    return F.col("publish_time").between(F.lit("2024-02-01").cast("timestamp"), F.lit("2024-11-30").cast("timestamp"))


def source_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest families of sources in a window of days: a top-k report."""
    return quality.families(e.documents(spark, sf_dir), PROFILES, _window(), quality.full_text(F.col("title"), F.col("content"), 600), 10, "rest")


def category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by known category, others and blanks."""
    d = e.documents(spark, sf_dir).withColumn("category", F.when(F.col("doc_id") % 9 == 0, " ").when(F.col("doc_id") % 9 == 1, None).otherwise(F.col("lang")))
    found = quality.categories(d, "category", ["fr", "en"], "blank", "unknown")
    return found.withColumn("place", F.col("place").cast("long"))


def source_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do about the 20 largest sources: a top-k report."""
    return quality.source_actions(e.documents(spark, sf_dir), quality.full_text(F.col("title"), F.col("content"), 900), 20, "src3", 30)


def category_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose category differs from that of their source's profile."""
    d = e.documents(spark, sf_dir).withColumn("category", F.when(F.col("doc_id") % 3 == 0, "ones").when(F.col("doc_id") % 3 == 1, F.col("source")))
    return quality.category_updates(d, "doc_id", "category", PROFILES)


def field_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled values of documents' fields, one of which isn't there."""
    return quality.completeness(b.table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "missing"])


def review_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions that agree with reviews: toxic against low quality, some without a review."""
    return quality.accuracy(_reviews(spark, sf_dir), "manual", "pred")


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = b.table(spark, sf_dir, "labels").join(b.table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id")
    return r.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "").otherwise((F.col("toxic") == 1).cast("string")).alias("manual"), F.upper((F.col("quality") == 0).cast("string")).alias("pred"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise("").alias("comment"), F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("source")).alias("reason"))


def wrong_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 8 most frequent reasons of wrong predictions: a top-k report."""
    return quality.wrong_reasons(_reviews(spark, sf_dir), "manual", "pred", ["comment", "reason"], 8, "none")


def link_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage and kinds of order links."""
    links = b.links(spark, sf_dir).withColumn("link_type", F.when(F.col("score") >= 0.96, "direct").otherwise("candidate"))
    return quality.link_quality(links, b.table(spark, sf_dir, "orders"))


def count_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table counts against an earlier snapshot."""
    t = {n: b.table(spark, sf_dir, n) for n in ("orders", "customer", "events")}
    before = quality.table_counts({"orders": t["orders"].filter("o_orderkey % 2 = 0"), "customer": t["customer"]})
    return quality.count_changes(quality.table_counts(t), before)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel.simple_returns(b.prices(spark, sf_dir))
    code = F.concat(F.lpad((F.col("entity") * 30011 % 1000000).cast("string"), 6, "0"), F.when(F.col("entity") % 7 == 0, ".BJ").otherwise(".SZ"))
    return p.select("entity", "day", "volume", rounded(F.col("daily_return") * 100, 2).alias("pct_chg"), code.alias("code"))


def panel_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel from changes in percent instead of closes."""
    return panel.daily_panel(_changes(spark, sf_dir), change="pct_chg").drop("code")


def panel_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel of changes with limit flags, and basics and factors of the day joined."""
    c = _changes(spark, sf_dir)
    basics = b.prices(spark, sf_dir).filter("entity % 3 <> 0").select("entity", "day", F.col("amount").alias("total_mv"), (F.col("volume") / 10).alias("volume_ratio"))
    factors = b.prices(spark, sf_dir).filter("entity % 2 = 0").select("entity", "day", (F.col("close") / 100).alias("adj_factor"))
    return panel.joined_panel(c, basics, factors)


def study_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many links were studied, and why others were not."""
    days, events = m._study(spark, sf_dir)
    return event_study.outcomes(events, days)


def study_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abnormal returns over all links and by three groupings."""
    days, events = m._study(spark, sf_dir)
    o = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderstatus").alias("status"), event_study.bucket3(F.col("o_totalprice") / 5000).alias("price_bucket"), event_study.bucket3(F.col("o_orderkey") % 100).alias("key_bucket"))
    rows = event_study.studied(events, days).filter("beta IS NOT NULL").join(o, "event_id")
    found = event_study.report(rows, ["status", "price_bucket", "key_bucket"], ["car_w1", "car_w5"])
    return found.select("grouping", "bucket", "metric", "n", rounded(F.col("mean"), 5).alias("mean"), rounded(F.col("t_stat"), 3).alias("t_stat"))


def stale_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored propagation edges after a run over some orders."""
    old = b.links(spark, sf_dir).select("event_id", F.col("entity").alias("source"), (F.col("entity") + 1).alias("target"), F.lit("old").alias("run")).distinct()
    new = old.filter("event_id % 3 = 0 AND source % 2 = 0").withColumn("run", F.lit("new"))
    return graph.without_stale_edges(old, new)


def labels_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First labels, channels, stances, allowed and anchored labels of documents."""
    d = e.documents(spark, sf_dir)
    rules = (("press", ("src3", "src4")), ("office", ("src1",)))
    stance = T.stance(F.substring("title", 1, 3), ("The", "Der"), ("De", "La"))
    return d.select("doc_id", T.first_label(F.col("source"), rules, "other").alias("first"), T.channel(F.col("lang"), F.col("source"), (("twos", ("src2",)), ("french", ("fr",))), ("en", "de"), "none").alias("channel"), stance.cast("long").alias("stance"), T.allowed(F.col("lang"), ("en", "fr"), "xx").alias("allowed"), T.anchored(F.col("title"), (("t", ("tion",)), ("h", ("heit",))), F.col("source")).alias("anchored"))


QUERIES = {
    f.__name__: f
    for f in (delivery_checks, delivery_status, cluster_statistics, dictionary_checks, source_families, category_summary, source_actions, category_updates, field_completeness, review_accuracy, wrong_reasons, link_quality, count_changes, panel_changes, panel_joined, study_outcomes, study_groups, stale_edges, labels_of_sources)
}

_FULLTEXT = "(length(content) >= {0} AND trim(content) <> trim(title) AND trim(content) <> trim(regexp_replace(title, '^[^：:]+[：:]', '')))"
_WINDOW = "publish_time BETWEEN TIMESTAMP '2024-02-01' AND TIMESTAMP '2024-11-30'"
_PROFILE = "CASE WHEN source LIKE 'src1%' THEN 'ones' WHEN source LIKE 'src2%' THEN 'twos' WHEN source LIKE '%5' THEN 'fives' ELSE {0} END"
_STATUS = "CASE WHEN {0} >= {1} THEN 'OK' WHEN {0} >= {2} THEN 'WARN' ELSE 'BLOCK' END"


def _ratio(table: str, area: str, metric: str, condition: str, ok: float, warn: float) -> str:
    v = f"CAST(count(*) FILTER ({condition}) AS DOUBLE) / count(*)"
    return f"SELECT {_q(area)} AS area, {_q(metric)} AS metric, {v} AS value, CAST({ok} AS DOUBLE) AS target, {_STATUS.format(v, ok, warn)} AS status FROM {table}"


def _count(table: str, area: str, metric: str, value: str, bound: float, good: str, bad: str) -> str:
    return f"SELECT {_q(area)}, {_q(metric)}, CAST({value} AS DOUBLE), CAST({bound} AS DOUBLE), CASE WHEN {value} {good} {bound} THEN 'OK' ELSE {_q(bad)} END FROM {table}"


_REVIEWS = "r AS (SELECT l.doc_id, CASE WHEN l.doc_id % 4 = 0 THEN '' ELSE CAST(toxic = 1 AS VARCHAR) END AS manual, CAST(quality = 0 AS VARCHAR) AS pred, CASE WHEN l.doc_id % 3 = 0 THEN coalesce(lang, '') ELSE '' END AS comment, CASE WHEN l.doc_id % 5 = 0 THEN '' ELSE source END AS reason FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
_CHG = "floor(r * 100 * 1e2 + 0.5) / 1e2"
_CHANGED = f"WITH {b.PRICES_SQL.replace('ret AS (SELECT *,', 'ret0 AS (SELECT *,', 1)}, ret AS (SELECT entity, day, volume, {_CHG} AS pct_chg, {_CHG} / 100 AS r FROM ret0)"
_PANEL = m._panel_sql(False).replace("SELECT entity, day, amount, volume, close,", "SELECT entity, day, volume, pct_chg,")

ORACLE_SQL = {
    "delivery_status": _delivery_sql(),
    "cluster_statistics": _CLUSTER_STATS,
    "delivery_checks": " UNION ALL ".join([
        _ratio("documents", "documents", "text_fill", "trim(text) <> ''", 0.98, 0.9), _ratio("documents", "documents", "lang_fill", "trim(lang) <> ''", 0.999, 0.5),
        _count("documents", "documents", "source_count", "count(DISTINCT source)", 8, ">=", "WARN"), _count("documents", "documents", "duplicate_texts", "(count(text) - count(DISTINCT text))", 0, "<=", "WARN"),
        _count("documents", "documents", "row_count", "count(*)", 1000, ">=", "BLOCK"), _count("orders", "orders", "row_count", "count(*)", 10, ">=", "BLOCK"), "SELECT 'not_there', 'table_presence', NULL, 5.0, 'BLOCK'",
        _ratio("orders", "orders", "open_ratio", "o_orderstatus = 'O'", 0.9, 0.2), _count("orders", "orders", "max_price", "max(o_totalprice)", 1e9, ">=", "BLOCK"), _count("orders", "orders", "priorities", "count(DISTINCT o_orderpriority)", 5, ">=", "BLOCK"),
        _ratio("lineitem", "lineitem", "discounted", "l_discount > 0.05", 0.35, 0.15), _count("lineitem", "lineitem", "symbols", "count(DISTINCT l_suppkey)", 50, ">=", "WARN"), _count("lineitem", "lineitem", "avg_score", "floor(avg(l_quantity) * 1e4 + 0.5) / 1e4", 0.35, ">=", "WARN"),
        _ratio("(SELECT * FROM customer WHERE c_custkey % 10 = 9)", "customer", "c_name_fill", "trim(c_name) <> ''", 0.8, 0.5), _count("(SELECT * FROM customer WHERE c_custkey % 10 = 9)", "customer", "rows", "count(*)", 1, ">=", "BLOCK"),
    ]),
    "dictionary_checks": """WITH x AS (SELECT count(*) FILTER (lang IS NULL OR lang <> 'en') AS l, count(*) FILTER (source IS NULL OR source NOT IN (SELECT 'src' || n_nationkey FROM nation)) AS s FROM documents)
SELECT 'documents' AS area, 'lang_dictionary_miss' AS metric, CAST(l AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS target, CASE WHEN l = 0 THEN 'OK' ELSE 'WARN' END AS status FROM x UNION ALL SELECT 'documents', 'source_dictionary_miss', s, 0, CASE WHEN s = 0 THEN 'OK' ELSE 'WARN' END FROM x UNION ALL SELECT 'dictionary', 'label_groups', 2, 10, 'BLOCK'""",
    "source_families": f"WITH {e._DOCS}, g AS (SELECT source, count(*) FILTER ({_WINDOW}) AS n, count(*) FILTER ({_WINDOW} AND {_FULLTEXT.format(600)}) AS k FROM docs GROUP BY 1 HAVING count(*) FILTER ({_WINDOW}) > 0) SELECT {_PROFILE.format(_q('rest'))} AS family, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(k) AS BIGINT) AS good_rows, round(sum(k) * 100 / sum(n), 2) AS pct FROM g GROUP BY 1 ORDER BY rows DESC, family LIMIT 10",
    "category_summary": "WITH c AS (SELECT CASE WHEN doc_id % 9 IN (0, 1) THEN 'blank' WHEN lang IN ('fr', 'en') THEN lang WHEN coalesce(trim(lang), '') = '' THEN 'blank' ELSE 'unknown' END AS category FROM documents) SELECT category, count(*) AS rows, CASE category WHEN 'fr' THEN 1 WHEN 'en' THEN 2 WHEN 'unknown' THEN 3 ELSE 4 END AS place FROM c GROUP BY 1",
    "source_actions": f"""WITH {e._DOCS}, g AS (SELECT source, count(*) AS rows, count(*) FILTER (trim(content) <> '') AS nonempty_rows, count(*) FILTER ({_FULLTEXT.format(900)}) AS good_rows FROM docs GROUP BY 1), p AS (SELECT *, round(good_rows * 100 / rows, 2) AS pct FROM g)
SELECT *, CASE WHEN source = 'src3' THEN 'keep_fulltext_backfill' WHEN rows < 30 THEN 'expand_collection' WHEN good_rows = 0 THEN 'source_is_thin' WHEN pct < 50 THEN 'improve_fulltext_fill_rate' ELSE 'keep_collecting' END AS action FROM p ORDER BY rows DESC, source LIMIT 20""",
    "category_updates": f"WITH d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'ones' WHEN 1 THEN source END AS c, {_PROFILE.format('source')} AS category FROM documents WHERE source IS NOT NULL) SELECT doc_id, category FROM d WHERE c IS DISTINCT FROM category",
    "field_completeness": "SELECT 'doc_id' AS field, 1.0 AS share UNION ALL SELECT 'text', avg(CAST(coalesce(trim(text) <> '', false) AS INT)) FROM documents UNION ALL SELECT 'lang', avg(CAST(coalesce(trim(lang) <> '', false) AS INT)) FROM documents UNION ALL SELECT 'missing', 0",
    "review_accuracy": f"WITH {_REVIEWS} SELECT count(*) FILTER (manual <> '' AND manual = pred) AS correct, count(*) FILTER (manual <> '') AS reviewed, count(*) FILTER (manual <> '' AND manual = pred) / count(*) FILTER (manual <> '') AS share FROM r",
    "wrong_reasons": f"WITH {_REVIEWS} SELECT coalesce(nullif(comment, ''), nullif(reason, ''), 'none') AS reason, count(*) AS n FROM r WHERE manual <> '' AND manual <> pred GROUP BY 1 ORDER BY n DESC, reason LIMIT 8",
    "link_quality": f"""WITH {b.LINKS_SQL}, l AS (SELECT * FROM links), t AS (SELECT count(*) AS n, count(DISTINCT event_id) AS c, avg(score) AS a, (SELECT count(*) FROM orders) AS e FROM l)
SELECT 'events' AS metric, CAST(e AS DOUBLE) AS value FROM t UNION ALL SELECT 'links', n FROM t UNION ALL SELECT 'covered_events', c FROM t UNION ALL SELECT 'coverage_pct', round(c * 100 / e, 2) FROM t UNION ALL SELECT 'mean_score', round(a, 4) FROM t
UNION ALL SELECT 'type:' || CASE WHEN score >= 0.96 THEN 'direct' ELSE 'candidate' END, count(*) FROM l GROUP BY 1""",
    "count_changes": "SELECT 'orders' AS name, count(*) AS rows, count(*) - count(*) FILTER (o_orderkey % 2 = 0) AS change FROM orders UNION ALL SELECT 'customer', count(*), 0 FROM customer UNION ALL SELECT 'events', count(*), NULL FROM events",
    "panel_changes": f"{_CHANGED} {_PANEL}",
    "panel_joined": f"""{_CHANGED}, pn AS ({_PANEL}), c AS (SELECT *, lpad(CAST(entity * 30011 % 1000000 AS VARCHAR), 6, '0') || CASE WHEN entity % 7 = 0 THEN '.BJ' ELSE '.SZ' END AS code FROM pn), l AS (SELECT *, CAST(CASE WHEN code LIKE '%.BJ' THEN 0.3 WHEN code LIKE '30%' OR code LIKE '68%' THEN 0.2 ELSE 0.1 END AS DOUBLE) * 100 - 0.3::DOUBLE AS edge FROM c)
SELECT l.* EXCLUDE (edge, volume_ratio), pct_chg >= edge AS is_limit_up, pct_chg <= -edge AS is_limit_down, CASE WHEN l.entity % 3 <> 0 THEN px.amount END AS total_mv, CASE WHEN l.entity % 3 <> 0 THEN px.volume / 10 END AS volume_ratio, CASE WHEN l.entity % 2 = 0 THEN px.close / 100 END AS adj_factor FROM l JOIN px ON l.entity = px.entity AND l.day = px.day""",
    "study_outcomes": f"{m._PX}, {m._DAYS} SELECT CASE WHEN al.idx IS NULL THEN alignment WHEN coalesce(estimation_points, 0) < 30 THEN 'insufficient_estimation_points' WHEN beta IS NULL THEN 'no_market_variance' ELSE 'studied_' || alignment END AS reason, count(*) AS n FROM al LEFT JOIN fit ON al.event_id = fit.event_id AND al.entity = fit.entity GROUP BY 1",
    "study_groups": f"""{m._PX}, {m._DAYS}, x AS (SELECT car.*, o_orderstatus AS status, CASE WHEN o_totalprice / 5000 < 33 THEN 'low' WHEN o_totalprice / 5000 < 66 THEN 'mid' ELSE 'high' END AS price_bucket, CASE WHEN o_orderkey % 100 < 33 THEN 'low' WHEN o_orderkey % 100 < 66 THEN 'mid' ELSE 'high' END AS key_bucket FROM car JOIN orders ON event_id = o_orderkey),
y AS ({' UNION ALL '.join(f"SELECT '{g}' AS grouping, {c} AS bucket, '{v}' AS metric, {v} AS v FROM x" for g, c in (('all', "'all'"), ('status', 'status'), ('price_bucket', 'price_bucket'), ('key_bucket', 'key_bucket')) for v in ('car_w1', 'car_w5'))})
SELECT grouping, bucket, metric, count(v) AS n, {m._r('avg(v)', 5)} AS mean, {m._r('CASE WHEN count(v) >= 2 AND stddev_samp(v) > 0 THEN avg(v) / (stddev_samp(v) / sqrt(count(v))) END', 3)} AS t_stat FROM y GROUP BY 1, 2, 3""",
    "stale_edges": f"WITH {b.LINKS_SQL}, o AS (SELECT DISTINCT event_id, entity AS source, entity + 1 AS target FROM links), n AS (SELECT * FROM o WHERE event_id % 3 = 0 AND source % 2 = 0) SELECT *, 'new' AS run FROM n UNION ALL SELECT *, 'old' FROM o WHERE event_id NOT IN (SELECT event_id FROM n)",
    "labels_of_sources": f"""WITH {e._DOCS} SELECT doc_id, CASE WHEN {_n('source', ('src3', 'src4'))} > 0 THEN 'press' WHEN {_n('source', ('src1',))} > 0 THEN 'office' ELSE 'other' END AS first, CASE WHEN contains(lang || ' ' || source, 'src2') THEN 'twos' WHEN contains(coalesce(lang, '') || ' ' || source, 'fr') THEN 'french' WHEN lang IN ('en', 'de') THEN lang ELSE 'none' END AS channel,
  CASE WHEN {_n('substr(title, 1, 3)', ('The', 'Der'))} > 0 THEN 1 WHEN {_n('substr(title, 1, 3)', ('De', 'La'))} > 0 THEN -1 ELSE 0 END AS stance, CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'xx' END AS allowed, CASE WHEN contains(title, 'tion') THEN 't' WHEN contains(title, 'heit') THEN 'h' ELSE source END AS anchored FROM docs""",
}
