"""Queries on daily series, samples, event studies and daily aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rounded
from ..operators import budget, daily, event_study, panel, samples
from ..operators.tables import written
from . import bindings as b


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.prices(spark, sf_dir).select("entity", "day", F.col("amount").alias("turnover"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.daily_panel(b.prices(spark, sf_dir)).select("entity", "day", "forward_return_1d", "forward_return_3d", "forward_return_5d")


def control_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers without a strong order link on the day, by turnover, with forward labels."""
    links = b.links(spark, sf_dir).select("entity", F.col("event_date").alias("day"), "score")
    return samples.control_samples(_features(spark, sf_dir), _labels(spark, sf_dir), links, per_day=100, min_score=0.35)


def panel_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.daily_panel(b.prices(spark, sf_dir))


def panel_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.daily_panel(b.prices(spark, sf_dir), "rolling")


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order links with rank, breadth, as-of turnover and forward labels."""
    found = samples.event_samples(b.links(spark, sf_dir), _features(spark, sf_dir), _labels(spark, sf_dir), 0.35)
    return found.select(
        "event_id", "entity", "event_date", "score", "group", F.col("relation_rank").cast("long"), "affected_entities", "affected_groups",
        F.col("f.day").alias("feature_day"), F.col("f.turnover").alias("turnover"), "forward_return_1d", "impact_level", F.col("feature_age_days").cast("long"),
    )


def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with its customer's latest earlier order: an as-of join."""
    o = b.table(spark, sf_dir, "orders")
    events = o.select(F.col("o_orderkey").alias("event_id"), (F.col("o_custkey") % 1000).alias("entity"), F.to_date("o_orderdate").alias("event_date"))
    found = samples.as_of(events, _features(spark, sf_dir))
    return found.select("event_id", "entity", "event_date", F.col("f.day").alias("feature_day"), F.col("f.turnover").alias("turnover"))


def _study(spark: SparkSession, sf_dir: str):
    # alignment and windows both read the days, which come from all order lines
    days = written(event_study.common_days(panel.simple_returns(b.prices(spark, sf_dir)), panel.simple_returns(b.market(spark, sf_dir))), "days")
    links = b.links(spark, sf_dir).filter("score >= 0.35").select("event_id", "entity", "event_date").distinct()
    return days, event_study.aligned(links, days)


def event_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _study(spark, sf_dir)[1].withColumn("idx", F.col("idx").cast("long"))


def market_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    days, events = _study(spark, sf_dir)
    fit = event_study.market_model(events, days)
    return fit.withColumns({c: rounded(F.col(c), 6) for c in ("alpha", "beta")})


def abnormal_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    days, events = _study(spark, sf_dir)
    cars = event_study.studied(events, days).filter("beta IS NOT NULL")
    return cars.select("event_id", "entity", *[rounded(F.col(f"car_w{w}"), 5).alias(f"car_w{w}") for w in (1, 3, 5)])


def budgeted_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The abnormal returns from a study in buckets of entities, of which a first run without time does none and the next the rest."""
    days, events = _study(spark, sf_dir)
    events, out, n = written(events, "aligned"), f"{b.shared_folder(spark)}/study-{uuid.uuid4().hex}", 3
    of = lambda k: event_study.studied(budget.bucket_of(events, "entity", n, k), budget.bucket_of(days, "entity", n, k)).filter("beta IS NOT NULL").select("event_id", "entity", "car_w1", "car_w3", "car_w5")
    for seconds in (0, 7200):
        budget.run(spark, of, out, n, seconds)
    return budget.results(spark, out, n).select("event_id", "entity", *[rounded(F.col(f"car_w{w}"), 5).alias(f"car_w{w}") for w in (1, 3, 5)])


def event_study_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and t-statistic of abnormal returns by the order's priority."""
    days, events = _study(spark, sf_dir)
    cars = event_study.studied(events, days).filter("beta IS NOT NULL")
    o = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), "o_orderpriority", "o_totalprice")
    bucket = event_study.bucket3(F.col("o_totalprice") / 5000)
    rows = cars.join(o, "event_id").withColumn("price_bucket", bucket)
    found = event_study.mean_and_t(rows, ["o_orderpriority", "price_bucket"], "car_w3")
    return found.select("o_orderpriority", "price_bucket", "n", rounded(F.col("mean"), 5).alias("mean"), rounded(F.col("t_stat"), 3).alias("t_stat"))


def cluster_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.cluster_daily(b.reports(spark, sf_dir))


def cluster_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.cluster_totals(b.reports(spark, sf_dir))


def sentiment_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = daily.sentiment_daily(b.reports(spark, sf_dir))
    return found.withColumn("streak", F.col("streak").cast("long"))


def market_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breadth of suppliers by day, the hottest nations, the joint series' state."""
    nation = b.table(spark, sf_dir, "supplier").join(b.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("entity"), F.col("n_name").alias("group"))
    quotes = panel.simple_returns(b.prices(spark, sf_dir)).join(nation, "entity", "left")
    found = daily.market_environment(quotes, panel.simple_returns(b.market(spark, sf_dir)), 10)
    hot = F.transform("hot_groups", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["group"], F.round(x["avg_return"] * 1e6).cast("long").cast("string"), x["n"].cast("string")))
    return found.withColumn("hot_groups", F.array_join(hot, ","))


QUERIES = {
    f.__name__: f
    for f in (control_samples, panel_previous, panel_rolling, event_samples, as_of_join, event_alignment, market_model, abnormal_returns, budgeted_returns, event_study_report, cluster_daily, cluster_totals, sentiment_daily, market_environment)
}


def _r(x: str, digits: int = 6) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def _panel_sql(rolling: bool) -> str:
    least = 2 if rolling else 1
    cols = []
    for n in (5, 20, 60):
        w = f"(PARTITION BY entity ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        cols.append(f"{_r(f'CASE WHEN count(r) OVER {w} >= {least} THEN product(1 + r) OVER {w} - 1 END')} AS trailing_return_{n}d")
        cols.append(f"{_r(f'stddev_samp(r) OVER {w}')} AS volatility_{n}d")
    w = "(PARTITION BY entity ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
    up = f"count(*) FILTER (r > 0) OVER {w}"
    cols.append(f"{up if rolling else f'CASE WHEN count(r) OVER {w} > 0 THEN {up} END'} AS up_days_20d")
    v = w if rolling else "(PARTITION BY entity ORDER BY day ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)"
    cols.append(f"{_r(f'volume / nullif(avg(volume) OVER {v}, 0)')} AS volume_ratio")
    for n in (1, 3, 5):
        w = f"(PARTITION BY entity ORDER BY day ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"
        cols.append(f"{_r(f'CASE WHEN count(r) OVER {w} >= {least} THEN product(1 + r) OVER {w} - 1 END')} AS forward_return_{n}d")
    return f"SELECT entity, day, amount, volume, close, {_r('r')} AS daily_return, {', '.join(cols)} FROM ret"


_LABELS = f"lab AS (SELECT entity, day, forward_return_1d, forward_return_3d, forward_return_5d FROM ({_panel_sql(False)}))"
_DAYS = """days AS (SELECT entity, day, r, m, row_number() OVER (PARTITION BY entity ORDER BY day) - 1 AS idx FROM ret JOIN mret USING (day) WHERE r IS NOT NULL AND m IS NOT NULL),
ev AS (SELECT DISTINCT o_orderkey AS event_id, l_suppkey AS entity, CAST(o_orderdate AS DATE) AS event_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity / 50 >= 0.35),
nx AS (SELECT ev.event_id, ev.entity, d.day, d.idx FROM ev ASOF JOIN days d ON ev.entity = d.entity AND ev.event_date <= d.day),
pv AS (SELECT ev.event_id, ev.entity, d.day, d.idx FROM ev ASOF JOIN days d ON ev.entity = d.entity AND ev.event_date >= d.day),
al AS (SELECT ev.*, CASE WHEN nx.day - event_date <= 7 THEN nx.day WHEN event_date - pv.day <= 7 THEN pv.day END AS trade_day,
  CASE WHEN nx.day - event_date <= 7 THEN nx.idx WHEN event_date - pv.day <= 7 THEN pv.idx END AS idx,
  CASE WHEN nx.day - event_date <= 7 THEN CASE WHEN nx.day = event_date THEN 'exact' ELSE 'aligned_next_trade_date' END WHEN event_date - pv.day <= 7 THEN 'aligned_prev_trade_date' ELSE 'no_trade_date_within_gap' END AS alignment
  FROM ev LEFT JOIN nx USING (event_id, entity) LEFT JOIN pv USING (event_id, entity)),
fit AS (SELECT event_id, al.entity, count(r) AS estimation_points, CASE WHEN count(r) >= 30 THEN regr_intercept(r, m) END AS alpha, CASE WHEN count(r) >= 30 THEN regr_slope(r, m) END AS beta
  FROM al JOIN days d ON al.entity = d.entity AND d.idx BETWEEN al.idx - 120 AND al.idx - 20 GROUP BY 1, 2),
car AS (SELECT al.event_id, al.entity, """ + ", ".join(f"CASE WHEN count(*) FILTER (d.idx - al.idx <= {w}) = {w + 1} THEN sum(r - (alpha + beta * m)) FILTER (d.idx - al.idx <= {w}) END AS car_w{w}" for w in (1, 3, 5)) + """
  FROM al JOIN fit ON al.event_id = fit.event_id AND al.entity = fit.entity JOIN days d ON al.entity = d.entity AND d.idx BETWEEN al.idx AND al.idx + 5 WHERE beta IS NOT NULL GROUP BY ALL)"""
_PX = "WITH " + b.PRICES_SQL

ORACLE_SQL = {
    "panel_previous": f"{_PX} {_panel_sql(False)}",
    "panel_rolling": f"{_PX} {_panel_sql(True)}",
    "control_samples": f"""{_PX}, {b.LINKS_SQL}, {_LABELS}
SELECT * EXCLUDE (k), forward_return_1d > 0 AS up_1d, forward_return_3d > 0 AS up_3d, forward_return_5d > 0 AS up_5d FROM (
  SELECT px.entity, px.day, amount AS turnover, forward_return_1d, forward_return_3d, forward_return_5d, 0 AS k,
    row_number() OVER (PARTITION BY px.day ORDER BY amount DESC NULLS LAST, px.entity) AS control_rank
  FROM px LEFT JOIN lab ON px.entity = lab.entity AND px.day = lab.day
  WHERE NOT EXISTS (SELECT 1 FROM links WHERE links.entity = px.entity AND links.event_date = px.day AND links.score >= 0.35)) WHERE control_rank <= 100""",
    "event_samples": f"""{_PX}, {b.LINKS_SQL}, {_LABELS},
sc AS (SELECT * FROM links WHERE score >= 0.35),
br AS (SELECT event_id, count(DISTINCT entity) AS affected_entities, count(DISTINCT nullif("group", '')) AS affected_groups FROM sc GROUP BY 1),
one AS (SELECT event_id, entity, event_date, "group", min(score) AS score FROM sc GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, entity) AS relation_rank FROM one),
f AS (SELECT rk.*, px.day AS feature_day, px.amount AS turnover FROM rk ASOF LEFT JOIN px ON rk.entity = px.entity AND rk.event_date >= px.day)
SELECT f.event_id, f.entity, f.event_date, score, "group", relation_rank, affected_entities, affected_groups, feature_day, turnover, forward_return_1d,
  CASE WHEN score >= 0.8 THEN 'S' WHEN score >= 0.6 THEN 'A' WHEN score >= 0.4 THEN 'B' ELSE 'C' END AS impact_level, CAST(f.event_date - feature_day AS BIGINT) AS feature_age_days
FROM f JOIN br USING (event_id) LEFT JOIN lab ON lab.entity = f.entity AND lab.day = f.event_date""",
    "as_of_join": f"""{_PX}, o AS (SELECT o_orderkey AS event_id, o_custkey % 1000 AS entity, CAST(o_orderdate AS DATE) AS event_date FROM orders)
SELECT event_id, o.entity, event_date, px.day AS feature_day, px.amount AS turnover FROM o ASOF LEFT JOIN px ON o.entity = px.entity AND o.event_date >= px.day""",
    "event_alignment": f"{_PX}, {_DAYS} SELECT * FROM al",
    "market_model": f"{_PX}, {_DAYS} SELECT event_id, entity, estimation_points, {_r('alpha')} AS alpha, {_r('beta')} AS beta FROM fit",
    "abnormal_returns": f"{_PX}, {_DAYS} SELECT event_id, entity, {', '.join(_r(f'car_w{w}', 5) + f' AS car_w{w}' for w in (1, 3, 5))} FROM car",
    "event_study_report": f"""{_PX}, {_DAYS} SELECT o_orderpriority, CASE WHEN o_totalprice / 5000 < 33 THEN 'low' WHEN o_totalprice / 5000 < 66 THEN 'mid' ELSE 'high' END AS price_bucket, count(car_w3) AS n,
  {_r('avg(car_w3)', 5)} AS mean, {_r('CASE WHEN count(car_w3) >= 2 AND stddev_samp(car_w3) > 0 THEN avg(car_w3) / (stddev_samp(car_w3) / sqrt(count(car_w3))) END', 3)} AS t_stat
FROM car JOIN orders ON event_id = o_orderkey GROUP BY 1, 2""",
    "cluster_daily": f"""WITH {b.REPORTS_SQL}, d AS (SELECT cluster, day, count(*) AS reports, count(DISTINCT source) AS media, count(*) FILTER (score > 0) AS positive, count(*) FILTER (score = 0) AS neutral, count(*) FILTER (score < 0) AS negative FROM rep GROUP BY 1, 2)
SELECT d.*, {_r('(d.reports - coalesce(p.reports, 0)) / (coalesce(p.reports, 0) + 1)')} AS growth,
  {_r('0.0 ' + ' '.join(f'- CASE WHEN d.{c} > 0 THEN d.{c} / d.reports * ln(d.{c} / d.reports) ELSE 0 END' for c in ('positive', 'neutral', 'negative')))} AS entropy
FROM d LEFT JOIN d p ON p.cluster = d.cluster AND p.day = d.day - 1""",
    "cluster_totals": f"WITH {b.REPORTS_SQL} SELECT cluster, count(*) AS reports, count(DISTINCT day) AS active_days, count(DISTINCT source) AS media, min(day) AS first_day, max(day) AS last_day FROM rep GROUP BY 1",
    "sentiment_daily": f"""WITH {b.REPORTS_SQL}, c AS (SELECT cluster, day, channel, count(*) AS reports, count(DISTINCT source) AS sources, count(*) FILTER (score > 0) AS positive, count(*) FILTER (score = 0) AS neutral, count(*) FILTER (score < 0) AS negative, sum(score) AS total, sum(score * score) AS squares FROM rep GROUP BY 1, 2, 3),
w AS (SELECT *, total / reports AS ms, sum(reports) OVER (PARTITION BY cluster, day) AS dr, lag(reports) OVER (PARTITION BY cluster, channel ORDER BY day) AS rb, day - CAST(row_number() OVER (PARTITION BY cluster, channel ORDER BY day) AS INTEGER) AS island FROM c)
SELECT cluster, day, channel, reports, sources, positive, neutral, negative, {_r('ms')} AS mean_score, {_r('sqrt(greatest(squares / reports - ms * ms, 0.0))')} AS spread, {_r('greatest(positive, neutral, negative) / dr')} AS dominant_share,
  {_r('max(ms) OVER (PARTITION BY cluster, day) - min(ms) OVER (PARTITION BY cluster, day)')} AS stance_range, {_r('CASE WHEN rb > 0 THEN (reports - rb) / rb END')} AS growth, row_number() OVER (PARTITION BY cluster, channel, island ORDER BY day) AS streak FROM w""",
    "market_environment": f"""{_PX}, q AS (SELECT ret.*, n_name AS g FROM ret LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) ON entity = s_suppkey),
br AS (SELECT day, count(*) FILTER (r > 0) AS up, count(*) FILTER (r < 0) AS down, count(*) FILTER (r = 0) AS flat, count(*) FILTER (r >= 0.097) AS limit_up, count(*) FILTER (r <= -0.097) AS limit_down, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM q GROUP BY 1),
gr AS (SELECT day, g, avg(r) AS a, count(*) AS n FROM q WHERE r IS NOT NULL GROUP BY 1, 2), h1 AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY {_r('a')} DESC, g) AS k FROM gr), hot AS (SELECT day, string_agg(k || ':' || g || ':' || CAST(floor(a * 1e6 + 0.5) AS BIGINT) || ':' || n, ',' ORDER BY k) AS hot_groups FROM h1 WHERE k <= 10 GROUP BY 1),
st AS (SELECT day, {_r('product(1 + m) OVER (ORDER BY day ROWS 4 PRECEDING) - 1')} AS benchmark_return_5d, {_r('stddev_samp(m) OVER (ORDER BY day ROWS 19 PRECEDING)')} AS benchmark_volatility_20d FROM mret WHERE m IS NOT NULL)
SELECT br.day, up, down, flat, limit_up, limit_down, amount, benchmark_return_5d, benchmark_volatility_20d, {_r('coalesce(down / nullif(up + down, 0), 0.5)')} AS risk_score, hot_groups FROM br LEFT JOIN hot USING (day) LEFT JOIN st USING (day)""",
}
ORACLE_SQL["budgeted_returns"] = ORACLE_SQL["abnormal_returns"]
