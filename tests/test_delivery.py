"""Delivery checks observed while writing, and cluster statistics by mergeable states."""

import datetime as dt

from eventloom.operators import cluster_stats, delivery
from pyspark.sql import functions as F


def test_observed_write_gives_the_checks_of_a_scan(spark, tmp_path):
    checks = delivery.PUBLISHED["stock_daily_quotes"]
    df = spark.range(12_000).selectExpr("id % 60 AS ts_code", "id AS open", "CASE WHEN id % 3 > 0 THEN id END AS high", "' ' AS low", "id AS amount", "id AS turnover_rate", "NULL AS adj_factor", "id % 900 = 0 AS is_limit_up", "false AS is_limit_down", "CASE WHEN id % 4 = 0 THEN 'x' ELSE 'sina' END AS data_source")
    watched, watch = delivery.observed(df, "stock_daily_quotes", checks)
    watched.write.parquet(f"file://{tmp_path}/quotes")
    got = {r[1]: r[2:] for r in delivery.observed_status(watch, "stock_daily_quotes", checks)}
    want = {r.metric: (r.value, r.target, r.status) for r in delivery.delivery_status({"stock_daily_quotes": df}, {"stock_daily_quotes": checks}).collect()}
    assert {m: v for m, v in want.items() if m != "symbol_count"} == got and want["symbol_count"] == (60.0, 50.0, "OK")
    assert got["high_fill"][2] == "BLOCK" and got["limit_flag_rows"][2] == "OK" and got["non_sina_source_rows"][2] == "WARN"
    empty, watch = delivery.observed(df.limit(0), "stock_daily_quotes", checks)
    empty.write.parquet(f"file://{tmp_path}/none")
    assert {r[4] for r in delivery.observed_status(watch, "stock_daily_quotes", checks)} == {"BLOCK"}


def test_missing_table_blocks(spark):
    rows = delivery.delivery_status({"label_dictionary": spark.createDataFrame([("g", "v")], "label_group string, label_value string")}).collect()
    assert {r.area for r in rows if r.metric == "table_presence"} == set(delivery.PUBLISHED) - {"label_dictionary"} and all(r.status == "BLOCK" for r in rows if r.metric == "table_presence")


def test_states_of_batches_equal_a_recount(spark):
    day = lambda n: None if n is None else dt.date(2024, 1, n)
    rows = [("c", day(1), "a", "g"), ("c", day(1), "a", "b"), ("c", day(2), None, "n"), ("c", day(4), "b", "g"), ("d", None, "z", "g"), ("d", day(3), "a", "x"), ("c", day(2), "b", "g"), ("c", day(2), "q", "g")]
    schema = "cluster string, day date, source string, sentiment string"
    one, two, all_ = (spark.createDataFrame(x, schema) for x in (rows[:5], rows[5:], rows))
    sides = ("g", "n", "b")

    def kept(*batches):
        state, dictionary = None, None
        for b in batches:
            dictionary = cluster_stats.with_new_sources(dictionary, b)
            state = cluster_stats.merged(state, cluster_stats.state(b, dictionary, sides))
        assert dictionary.count() == dictionary.select("number").distinct().count()
        return sorted(map(str, cluster_stats.refreshed(all_, state).collect()))

    assert kept(one, two) == kept(all_) == kept(two, one, two.limit(0))
    state = cluster_stats.state(all_, cluster_stats.with_new_sources(None, all_), sides)
    got = {(r.cluster, r.day): r for r in cluster_stats.refreshed(all_, state).collect()}
    c2 = got["c", day(2)]
    assert (c2.report_count, c2.media_coverage_count, c2.heat_duration_days, c2.heat_growth_rate) == (6, 3, 3, round((3 - 2) / 3, 6))
    assert got["d", None].report_count is None and got["d", day(3)].heat_duration_days == 2 and got["c", day(4)].heat_growth_rate == 0
    assert {r.cluster for r in cluster_stats.touched(state, all_.filter("cluster = 'd'")).collect()} == {"d"}
    assert cluster_stats.refreshed(all_.limit(0), state).filter(F.lit(True)).count() == 0
