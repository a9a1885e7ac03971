"""Small cases with hand-computed results."""

import datetime as dt

import pytest
from eventloom.functions import numeric, text
from eventloom.operators import canonical, detect, event_study, graph, lineage, linking, panel, quality, retrieval, rules, samples, upsert
from eventloom.sources import files
from eventloom.streaming import jobs
from pyspark.sql import functions as F

DOC = "source string, title string, content string, publish_time timestamp, url string, symbol_or_subject string"
DAY = dt.datetime(2025, 3, 1, 10)


def test_golden_classification(spark):
    rows = [
        ("巨潮资讯网/历史公告", "测试公司：关于签订重大合同的公告", "公司近日与某客户签订重大合同，合同金额为5亿元。", DAY, "u1", "000001.SZ"),
        ("中国政府网/新华社", "国务院印发新一轮稳增长政策措施", "国务院发布政策措施，支持制造业升级和扩大内需。", DAY, "u2", ""),
        ("巨潮资讯网/历史公告", "测试公司：关于召开2025年第一次临时股东大会的通知", "公司将召开股东大会审议议案。", DAY, "u3", "000001.SZ"),
    ]
    docs = spark.createDataFrame(rows, DOC).withColumn("duplicate_group_size", F.lit(1))
    got = {r["url"]: r for r in detect.classified(detect.detected(docs, rules.PUBLISHED), rules.PUBLISHED).collect()}
    assert got["u1"]["is_event"] and got["u2"]["is_event"] and not got["u3"]["is_event"]
    assert got["u3"]["filter_reason"] == "generic_announcement_without_signal"
    assert [got["u1"][c] for c in ("subject_type", "predictability_type", "duration_type", "sentiment")] == ["公司类", "预披露型", "中期型", "利好"]
    assert [got["u2"][c] for c in ("subject_type", "predictability_type", "duration_type", "sentiment")] == ["政策类", "预披露型", "中期型", "利好"]
    assert got["u1"]["amount_yuan"] == 5e8


def test_feedback_keywords():
    pack = rules.merged(rules.PUBLISHED, {"subject": {"公司类": ["新词", "合同"]}})
    assert pack.subject["公司类"][-1] == "新词" and pack.subject["公司类"].count("合同") == 1


def test_alignment_and_model(spark):
    days = spark.createDataFrame([("a", dt.date(2025, 1, 2), 0.0, 0.0, 0), ("a", dt.date(2025, 1, 3), 0.0, 0.0, 1)], "entity string, day date, r double, m double, idx int")
    events = spark.createDataFrame([(1, "a", dt.date(2025, 1, 4)), (2, "a", dt.date(2025, 1, 9)), (3, "b", dt.date(2025, 1, 3))], "event_id long, entity string, event_date date")
    got = {r["event_id"]: (r["idx"], r["alignment"]) for r in event_study.aligned(events, days, 2).collect()}
    assert got == {1: (1, "aligned_prev_trade_date"), 2: (None, "no_trade_date_within_gap"), 3: (None, "no_trade_date_within_gap")}
    start = dt.date(2025, 1, 1)
    line = [("a", start + dt.timedelta(i), 0.01 + 1.5 * i / 1000, i / 1000, i) for i in range(1, 60)]
    days = spark.createDataFrame(line, "entity string, day date, r double, m double, idx int")
    one = spark.createDataFrame([(1, "a", 59)], "event_id long, entity string, idx int")
    fit = event_study.market_model(one, days, (-58, -1)).first()
    assert fit["alpha"] == pytest.approx(0.01, abs=1e-4) and fit["beta"] == pytest.approx(1.5, abs=1e-4)


def test_abnormal_returns(spark):
    days = spark.createDataFrame([("a", dt.date(2025, 1, 1) + dt.timedelta(i), 0.02, 0.01, i) for i in range(9)], "entity string, day date, r double, m double, idx int")
    event = spark.createDataFrame([(1, "a", 3), (2, "a", 8)], "event_id long, entity string, idx int")
    model = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 1.0)], "event_id long, alpha double, beta double")
    got = {r["event_id"]: r for r in event_study.abnormal_returns(event, days, model, (1, 3)).collect()}
    assert got[1]["car_w1"] == pytest.approx(0.02) and got[1]["car_w3"] == pytest.approx(0.04) and got[2]["car_w1"] is None


def test_bad_close_breaks_the_chain(spark):
    rows = [("a", d, c) for d, c in (("2025-01-01", "10"), ("2025-01-02", "11"), ("2025-01-03", "bad"), ("2025-01-04", "12"))]
    df = spark.createDataFrame(rows, "entity string, day string, close string").withColumn("close", numeric.lenient_double(F.col("close")))
    got = {r["day"]: r["daily_return"] for r in panel.simple_returns(df).collect()}
    assert got["2025-01-02"] == pytest.approx(0.1) and got["2025-01-04"] is None


def test_symbols_numbers_and_lists(spark):
    s = text.quote_symbols(F.col("c"))
    got = spark.createDataFrame([("000001.SZ",), ("600000.SH",), ("430001.BJ",)], "c string").select(s.prefixed, s.numbered).collect()
    assert [tuple(r) for r in got] == [("sz000001", "0.000001"), ("sh600000", "1.600000"), ("bj430001", "0.430001")]
    one = spark.range(1).select(text.list_items(F.lit("a，b, ,c")).alias("l"), text.list_items(F.lit('["x","y"]')).alias("j"), text.amount_yuan(F.lit("约3万亿与5亿美元")).alias("a"), numeric.lenient_int(F.lit("1,234.9")).alias("i"))
    r = one.first()
    assert r["l"] == ["a", "b", "c"] and r["j"] == ["x", "y"] and r["a"] == 3e12 and r["i"] == 1234


def test_chunks_and_search(spark):
    df = spark.createDataFrame([(1, "aa\nbb\n\ncccccc\ndd"), (2, ""), (3, None)], "id long, text string")
    got = [(r["id"], r["chunk"], r["content"]) for r in retrieval.chunked(df, "id", "text", 5).orderBy("id", "chunk").collect()]
    assert got == [(1, 0, "aa\nbb"), (1, 1, "cccccc"), (1, 2, "dd")]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert sorted(map(tuple, upsert.upserted(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    blank = spark.createDataFrame([(2, ""), (3, "d")], "k long, v string")
    assert sorted(map(tuple, upsert.filled_from(old, blank, "k", ["v"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    staged = upsert.staged(spark.createDataFrame([("7", ""), ("x", "z")], "n string, t string"), {"n": "int"}, {"n": 0, "t": "none"})
    assert sorted(map(tuple, staged.collect())) == [(0, "z"), (7, "none")]


def test_links_zero_without_match(spark):
    columns = "event_id long, entity long, industry_match int, symbol_match int, name_match int, event_hits int, entity_hits int, tag_hits int, title_hits int, specific boolean"
    rows = [(1, 1, 1, 0, 0, 3, 3, 2, 2, True), (1, 2, 0, 0, 0, 3, 3, 2, 2, False), (1, 3, 1, 1, 1, 6, 3, 2, 2, True), (1, 4, 1, 0, 0, 0, 0, 0, 0, False)]
    got = {r["entity"]: r["score"] for r in linking.scored(spark.createDataFrame(rows, columns)).collect()}
    assert got[1] == got[2] == got[4] == 0 and got[3] == pytest.approx(1.08)


def test_propagation_directions(spark):
    links = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.1)], "event_id long, entity long, score double")
    relations = spark.createDataFrame([(1, 10, 20, 0.5, "directed"), (2, 30, 10, 0.5, "undirected"), (3, 40, 10, 0.5, "directed"), (4, 10, 10, 1.0, "directed"), (5, 10, 20, 0.6, "directed")], "relation_id long, source long, target long, strength double, direction string")
    got = {r["target"]: (r["relation_id"], r["score"]) for r in graph.propagated(links, relations).collect()}
    assert got == {20: (5, 0.54), 30: (2, 0.45)}


def test_as_of_without_earlier_row(spark):
    f = spark.createDataFrame([("a", dt.date(2025, 1, 5), 1.0)], "entity string, day date, turnover double")
    e = spark.createDataFrame([(1, "a", dt.date(2025, 1, 4)), (2, "a", dt.date(2025, 1, 5)), (3, "b", dt.date(2025, 1, 6))], "event_id long, entity string, event_date date")
    assert {r["event_id"]: r["f"] and r["f"]["turnover"] for r in samples.as_of(e, f).collect()} == {1: None, 2: 1.0, 3: None}


def test_quality(spark):
    df = spark.createDataFrame([("标题", "标题"), ("标题", "正文" * 200)], "t string, c string")
    assert [r[0] for r in df.select(quality.good_body(F.col("t"), F.col("c"), 300)).collect()] == [False, True]


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿source,title,content,publish_time,url,symbol_or_subject\ns,t,c\x00d,2025-01-01,u,\ns,t,c,2025-01-01,local://manual-seed,\n", encoding="utf-8")
    docs = files.documents_csv(spark, f"file://{tmp_path}/a.csv", f"file://{tmp_path}/none.csv")
    assert [(r["content"], r["url"], r["source"]) for r in docs.collect()] == [("cd", "u", "s")]
    spark.createDataFrame([("u1", 1), ("u1", 1), ("u2", 2)], "url string, n long").write.parquet(f"file://{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema("url string, n long").parquet(f"file://{tmp_path}/in")
        jobs.classify_stream(stream, lambda b: b.withColumn("label", F.lit("x")), f"file://{tmp_path}/out", f"file://{tmp_path}/ck").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 2


def test_lineage(spark, tmp_path):
    path = f"file://{tmp_path}/runs"
    lineage.record(spark, path, "r", "s", "running", DAY, metadata={"a": "1", "b": "1"})
    lineage.record(spark, path, "r", "s", "success", DAY + dt.timedelta(minutes=1), 5, metadata={"b": "2"})
    r = lineage.latest(spark.read.parquet(path)).first()
    assert (r["status"], r["rows"], r["metadata"]) == ("success", 5, {"a": "1", "b": "2"})


def test_enrichment(spark):
    from eventloom.operators import enrich

    t = F.lit("公司拟在北京市扩产锂矿设备，全国首个，风险可控")
    r = spark.range(1).select(
        enrich.sentiment_score(t, F.lit("利好")).alias("s"), enrich.chain_stages(t).alias("c"), enrich.impact_scope(t, F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("i"), enrich.confidence(t, F.lit("重大合同"), F.lit("其他"), F.lit("利好"), F.array(F.lit("x")), F.lit(9)).alias("k"),
        enrich.primary_industry(enrich.industry_scores(F.lit("锂"), F.lit(""), F.lit("锂 药"), F.lit(""), F.lit(""), {"医药": ("药",), "金属": ("锂",)})).alias("p"),
    ).first()
    assert r["s"] == 57 and r["c"] == ["上游资源材料", "设备零部件"] and r["i"] == "全国面"
    assert r["k"] == pytest.approx(0.35 + 0.15 + 0.1 + 0.1 + 0.12 - 0.02) and tuple(r["p"]) == ("金属", 1)


def test_source_priority(spark):
    from eventloom.operators import enrich

    cache = spark.createDataFrame([("hs300", "2025-01-01", 0.1)], "entity string, day string, daily_return double")
    market = spark.createDataFrame([("hs300", "2025-01-01", 0.2), ("x", "2025-01-02", 0.3), ("y", "2025-01-02", None)], "entity string, day string, daily_return double")
    got = sorted((r["entity"], r["daily_return"], r["source"]) for r in enrich.resolved_series([("cache", cache), ("fallback", market)]).collect())
    assert got == [("hs300", 0.1, "cache"), ("x", 0.3, "fallback")]


def test_names_of_one_character_merge(spark):
    day = dt.date(2024, 1, 1)
    names = {1: "a", 2: "alpha", 3: "a", 4: "bet", 5: "", 6: "t", 7: "a"}
    events = spark.createDataFrame([(i, "s", "x", day + dt.timedelta(days=20 * (i == 7)), [], n, [], []) for i, n in names.items()], "id long, subject string, industry string, day date, entities array<string>, name string, name_tokens array<string>, all_tokens array<string>")
    assert {tuple(r) for r in canonical.merge_pairs(events).collect()} == {(1, 2), (1, 3), (2, 3), (4, 6)}


def test_golden_cases_of_the_published_packs(spark):
    from eventloom.operators import structured

    docs = spark.createDataFrame(
        [
            ("巨潮资讯网/历史公告", "测试公司：关于签订重大合同的公告", "公司近日与某客户签订重大合同，合同金额为5亿元。", "2025-03-01 10:00:00", "u1", "000001.SZ"),
            ("中国政府网/新华社", "国务院印发新一轮稳增长政策措施", "国务院发布政策措施，支持制造业升级和扩大内需。", "2025-03-02 09:00:00", "u2", ""),
            ("巨潮资讯网/历史公告", "测试公司：关于召开2025年第一次临时股东大会的通知", "公司将召开股东大会审议议案。", "2025-03-01 10:00:00", "u3", "000001.SZ"),
            ("财新网", "光伏逆变器企业扩产，储能订单增长", "无人机与雷达企业的军品订单", "2025-03-01 10:00:00", "u4", ""),
        ],
        "source string, title string, content string, publish_time string, url string, symbol_or_subject string",
    ).withColumn("publish_time", F.to_timestamp("publish_time"))
    found = detect.detected(detect.with_duplicates(docs), rules.PUBLISHED)
    reasons = {r.url: (r.is_event, r.filter_reason) for r in found.collect()}
    assert reasons["u1"][0] and reasons["u2"][0] and reasons["u3"] == (False, "generic_announcement_without_signal")
    rows = {r.url: r for r in structured.structured(found, rules.PUBLISHED, structured.PUBLISHED).collect()}
    labels = lambda u: tuple(rows[u][c] for c in ("event_subject_type", "event_subject_subtype", "predictability_type", "duration_type", "impact_scope", "sentiment"))
    assert labels("u1") == ("公司类", "重大合同", "预披露型", "中期型", "个股链条", "利好")
    assert labels("u2") == ("政策类", "产业政策", "预披露型", "中期型", "行业", "利好")
    # three words each: the earlier rule wins
    assert rows["u4"].industry_type == "军工" and rows["u4"].event_subject_subtype == "重大合同"


def test_totals_of_propagation_are_those_of_its_rows(spark):
    links = spark.createDataFrame([(e, e % 3, s) for e, s in enumerate((0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 0.35, 0.36))], "event_id long, entity long, score double")
    rows = [(1, 0, 1, 0.3, "directed"), (5, 0, 1, 0.9, "directed"), (9, 1, 0, 0.4, "undirected"), (7, 2, 5, 0.9, "directed"), (8, 2, 2, 0.9, "directed"), (3, 2, 5, 0.1, "undirected"), (4, 1, 6, 0.2, "directed")]
    relations = spark.createDataFrame(rows, "relation_id long, source long, target long, strength double, direction string")
    found = graph.propagated(links, relations).groupBy("source", "target").agg(F.count(F.lit(1)).alias("edges"), F.max("score").alias("best"), F.max("relation_id").alias("relation_id"))
    totals = graph.propagated_totals(links, relations)
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, found.select(*totals.columns).collect())) and totals.count() >= 3
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan.lower() and plan.count("Join") == 1


def test_event_studies_read_no_frame_anew_for_each_row(spark):
    import datetime as dt
    import random

    rng = random.Random(1)
    first = dt.date(2024, 1, 1)
    days = [(e, first + dt.timedelta(k), rng.gauss(0, 1), 0.1 if e == 1 else rng.gauss(0, 1), k) for e in (1, 2) for k in range(200)]
    days = spark.createDataFrame(days, "entity long, day date, r double, m double, idx int")
    events = spark.createDataFrame([(k, 1 + k % 2, first + dt.timedelta(k * 3)) for k in range(70)], "event_id long, entity long, event_date date")
    placed = event_study.aligned(events, days)
    assert "UnboundedFollowing" not in placed._jdf.queryExecution().toString().replace(" ", "") and "unboundedfollowing" not in placed._jdf.queryExecution().toString()
    got = event_study.studied(placed, days)
    assert "rangeframe" not in got._jdf.queryExecution().toString().lower()
    by = {(r["entity"], r["idx"]): r for r in days.collect()}
    for x in got.collect():
        past = [by[x["entity"], i] for i in range(x["idx"] - 120, x["idx"] - 19) if i >= 0]
        assert x["estimation_points"] == len(past)
        if x["entity"] == 1 or len(past) < 30:
            assert x["beta"] is None and x["alpha"] is None and x["car_w3"] is None
            continue
        mr, mm = sum(p["r"] for p in past) / len(past), sum(p["m"] for p in past) / len(past)
        beta = sum((p["r"] - mr) * (p["m"] - mm) for p in past) / sum((p["m"] - mm) ** 2 for p in past)
        assert abs(x["beta"] - beta) < 1e-9 and abs(x["alpha"] - (mr - beta * mm)) < 1e-9
        ahead = [by.get((x["entity"], x["idx"] + k)) for k in range(4)]
        assert x["car_w3"] is None if None in ahead else abs(x["car_w3"] - sum(p["r"] - x["alpha"] - x["beta"] * p["m"] for p in ahead)) < 1e-9


def test_panels_read_no_frame_anew_for_each_row(spark):
    closes = [(1, k, c, v) for k, (c, v) in enumerate([(10.0, 1.0), (11.0, None), (0.0, 3.0), (5.0, 0.0), (6.0, 2.0), (6.6, 4.0)])] + [(2, 0, 1.0, 1.0), (3, 0, 2.0, 0.0), (3, 1, 2.0, 0.0), (3, 2, 2.0, 0.0)]
    series = spark.createDataFrame(closes, "entity long, day int, close double, volume double")
    got = panel.daily_panel(series)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1  # only the close before
    by = {(r["entity"], r["day"]): r for r in got.collect()}
    assert by[1, 0]["daily_return"] is None and by[1, 3]["daily_return"] is None and by[2, 0]["trailing_return_5d"] is None and by[2, 0]["up_days_20d"] is None
    assert (by[1, 1]["trailing_return_5d"], by[1, 2]["daily_return"], by[1, 0]["forward_return_1d"], by[1, 4]["forward_return_3d"], by[1, 5]["forward_return_1d"]) == (0.1, -1.0, 0.1, 0.1, None)
    assert by[1, 1]["volatility_5d"] is None and by[3, 2]["volatility_5d"] == 0.0 and by[1, 5]["up_days_20d"] == 3
    assert (by[1, 0]["volume_ratio"], by[1, 1]["volume_ratio"], by[1, 2]["volume_ratio"], by[1, 5]["volume_ratio"], by[3, 2]["volume_ratio"]) == (None, None, 3.0, 2.4, None)


def test_links_are_dealt_by_event_and_rows(spark, sf, monkeypatch):
    """A task's share of links doesn't grow with the table, and an event's links lie in one task."""
    from eventloom.operators import tables
    from eventloom.plans import bindings as b

    monkeypatch.setattr(tables, "ROWS", 500, raising=False)
    found = b.links(spark, sf).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.collect_set("event_id").alias("events")).collect()
    assert len(found) > 4 and max(r.n for r in found) < 1_500
    assert sum(len(r.events) for r in found) == len({x for r in found for x in r.events})
