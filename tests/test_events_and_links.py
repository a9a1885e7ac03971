"""Hand-made cases: structured events by the published rules, entities, links, clusters, enrichment, companies."""

import datetime as dt

import pytest
from eventloom.functions import text as T
from eventloom.operators import companies, detect, enrich, entities, linking, quality, relations, rules, structured, tables
from eventloom.sources import files
from pyspark.sql import functions as F

DOC = "url string, source string, title string, content string, publish_time timestamp, symbol_or_subject string, doc_id long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        ("u1", "巨潮资讯网/历史公告", "测试公司：关于签订重大合同的公告", "公司近日与某客户签订重大合同，合同金额为5亿元。", dt.datetime(2025, 3, 1, 10), "000001.SZ", 1),
        ("u2", "中国政府网/新华社", "国务院印发新一轮稳增长政策措施", "国务院发布政策措施，支持制造业升级和扩大内需。", dt.datetime(2025, 3, 2, 9), "", 2),
        ("u3", "巨潮资讯网/历史公告", "测试公司：关于召开2025年第一次临时股东大会的通知", "公司将召开股东大会审议议案。", dt.datetime(2025, 3, 1, 10), "000001.SZ", 3),
    ]
    return spark.createDataFrame(rows, DOC)


def test_structured_events_by_the_published_rules(docs):
    found = structured.structured(detect.with_duplicates(docs), rules.PUBLISHED, structured.PUBLISHED, "symbol_or_subject")
    got = {r["url"]: r for r in found.collect()}
    one, two = got["u1"], got["u2"]
    assert [one[c] for c in ("event_subject_type", "event_subject_subtype", "predictability_type", "duration_type", "impact_scope", "sentiment")] == ["公司类", "重大合同", "预披露型", "中期型", "个股链条", "利好"]
    assert [two[c] for c in ("event_subject_type", "event_subject_subtype", "predictability_type", "duration_type", "impact_scope", "sentiment")] == ["政策类", "产业政策", "预披露型", "中期型", "行业", "利好"]
    assert one["subject_entities"][:2] == ["测试公司", "000001.SZ"] and one["event_name"] == "测试公司相关事件"
    assert (one["source_type"], one["authority_level"], one["source_credibility_score"], one["amount_scale"]) == ("公司公告", "listed_company", 3, "small")
    assert one["explicitness_score"] == 2 and one["event_code"].split("-")[:2] == ["公司类", "重大合同"]
    assert one["event_summary"] == "测试公司：关于签订重大合同的公告。公司近日与某客户签订重大合同，合同金额为5亿元"
    reasons = {r["url"]: (r["is_event"], r["filter_reason"], r["evidence"]) for r in structured.candidates(docs, rules.PUBLISHED).collect()}
    assert reasons["u1"][0] and reasons["u2"][0] and reasons["u3"][:2] == (False, "generic_announcement_without_signal") and "subject:" in reasons["u1"][2]


def test_amount_scale_and_entities(spark):
    texts = ["5000万元", "80万元", "2万亿", "50亿", "150亿元", "none", "5亿美元"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(structured.amount_scale(F.col("t"), structured.PUBLISHED).alias("s"))
    assert [r["s"] for r in df.collect()] == ["huge", "small", "huge", "medium", "large", "none", "small"]
    one = spark.range(1).select(
        entities.subject_entities(F.lit("600000.SH 与华夏银行、关于银行，ST 中东"), entities.PUBLISHED).alias("e"), entities.phrase(F.lit(" 某 事件公告 ")).alias("p"), entities.tokens(F.lit("新能源 AI公告 x 事件")).alias("t")
    ).first()
    assert one["e"] == ["600000.SH", "与华夏银行", "中东"] and one["p"] == "某" or one["p"] == "某事件"
    assert one["t"] == ["新能源", "AI"]


def test_names_in_texts(spark):
    names = spark.createDataFrame([("ab",), ("abc",), ("",), (None,), ("bc",)], "name string")
    df = spark.createDataFrame([(1, "xabcx"), (2, None), (3, "")], "i long, t string")
    for size in (1 << 20, 2):  # in one pass and in several
        got = {r["i"]: sorted(r["f"]) for r in df.select("i", entities.held(df, names, max_chars=size)(F.col("t")).alias("f")).collect()}
        assert got == {1: ["ab", "abc", "bc"], 2: [], 3: []}


LINKS = "event_id string, members array<long>, name string, summary string, industry string, subject string, title string, content string, symbol string"
FIRMS = "entity long, place long, code string, name string, industry string, text string, tags array<string>"


def test_links_by_symbol_name_tag_and_industry(spark):
    events = [
        ("a", [101, 102], "测试事件", "", "科技", "公司类", "标题", "内容", "000007"),
        ("b", [103], "芯片", "", "科技", "行业类", "芯片 算力 提速", "机器人", "行业/市场新闻"),
        ("c", [104], "政策", "", "其他", "政策类", "通知", "政策 方案", ""),
        ("d", [105], "x", "", "消费", "公司类", "旅游公司七 提价", "", ""),
    ]
    firms = [(7, 0, "000007.SZ", "测试公司", "C39", "芯片 半导体", ["算力"]), (8, 1, "000008.SZ", "另一家", "I65", "软件", ["机器人", "算力"]), (9, 2, "000009.SZ", "公司七", "H61", "旅游 酒店", []), (10, 3, "000010.SZ", "", "J66", "政策", ["方案"])]
    firms += [(20 + i, 20 + i, f"{i:06d}.BJ", f"firm{i}", "C39", "芯片 通信 AI" if i % 2 else "", []) for i in range(11, 21)]
    e, f = spark.createDataFrame(events, LINKS), spark.createDataFrame(firms, FIRMS)
    got = linking.links(e, f, linking.PUBLISHED, 3).collect()
    by = {}
    for r in got:
        by.setdefault(r["member"], []).append((r["rank"], r["entity"], r["link_type"]))
    assert sorted(by[101]) == sorted(by[102]) == [(1, 7, "direct_match")]  # a specific symbol links to its own entity only
    assert [k for _, _, k in sorted(by[103])] == ["industry_match"] * 3 and {8, 7} <= {x for _, x, _ in by[103]}
    assert sorted(by[105])[0] == (1, 9, "direct_match")
    # every pair scored, brute force: the same links
    features = linking.event_features(e, f, linking.PUBLISHED)
    assert {r["event_id"] for r in features.filter("generic").collect()} == {"b", "c", "d"}
    assert 104 not in by or all(x != 10 or k != "candidate" for _, x, k in by[104])


def test_cluster_projection(spark):
    events = spark.createDataFrame([(1, "e1", "n1", "t", "c1", "s", ""), (2, "e2", "n2", "t", "c2", "s", "z"), (3, "e3", "n3", "u", None, None, "z")], "id long, event_id string, name string, title string, content string, symbol string, summary string")
    clusters = spark.createDataFrame([("C", "e1", False), ("C", "e2", True)], "canonical_event_id string, event_id string, is_representative boolean")
    got = {r["canonical_event_id"]: r for r in linking.cluster_events(events, clusters).collect()}
    assert (got["C"]["event_id"], got["C"]["name"], got["C"]["title"], got["C"]["content"], got["C"]["members"], got["C"]["cluster_size"]) == ("e2", "n2", "t", "c1 | c2", [1, 2], 2)
    assert (got["e3"]["content"], got["e3"]["symbol"], got["e3"]["members"]) == ("", "", [3])


def test_categories(spark):
    codes = ["C39", "C26 化学", "C99", "D44", "J66", "Z03x", "科技", "", None, "Y1"]
    got = [r["c"] for r in spark.createDataFrame([(c,) for c in codes], "x string").select(linking.category(F.col("x"), linking.PUBLISHED).alias("c")).collect()]
    assert got == ["科技", "新能源", "消费", "新能源", "其他", "军工", "科技", "其他", "其他", "其他"]


def test_enrichment_of_a_published_text(spark):
    row = [("标题：光伏芯片项目", "e", "芯片 摘要", "美国与中国 江苏南京市 上游材料 2亿元", "rule", "src", "科技", ["a", "b"], "利好", "公司公告", "central", "", "", "重大合同", 2)]
    columns = "title string, event_name string, event_summary string, content string, classification_evidence string, source string, industry_type string, subject_entities array<string>, sentiment string, source_type string, authority_level string, predictability_type string, shock_source_type string, event_subject_subtype string, trigger_word_score int"
    df = spark.createDataFrame(row, columns)
    r = enrich.enriched(df).first()
    assert (r["sw_l1_industry"], r["sw_l1_industry_code"]) == ("电子", "801080") and r["country_count"] == 2 and r["impact_scope"] == "全球面"
    assert (r["amount_max_rmb"], r["company_count"], r["province_count"], r["chain_stages"], r["source_credibility_type"]) == (2e8, 2, 1, ["上游资源材料"], "官方原文")
    assert r["classification_confidence"] == pytest.approx(0.35 + 0.15 + 0.15 + 0.1 + 0.1 + 0.06) and r["sentiment_score_0_100"] == 62
    b = enrich.enriched(df, backfill=True).first()
    assert b["classification_confidence"] == pytest.approx(0.35 + 0.15 + 0.1 + 0.1)


def test_companies_and_relations(spark):
    df = spark.createDataFrame([("600000",), ("300001",), ("873001",), ("123456",)], "c string")
    got = df.select(companies.listing(F.col("c")), companies.listing(F.col("c"), True), companies.symbol_listing(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("600000.SH", "600000.SH", "600000.SH"), ("300001.SZ", "300001.SZ", "300001.SZ"), ("873001.BJ", "873001.BJ", "873001.BJ"), ("123456", "", "")]
    firms = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "id long, code string, name string")
    seed = spark.createDataFrame([("b ", "", "", "a", "t", "2", "", 1), ("A", "", "B", "", "t", "-1", "directed", 2), ("A", "", "?", "?", "t", "", "", 3), ("A", "", "B", "", " ", "", "", 4)], "source_ts_code string, source_company_name string, target_ts_code string, target_company_name string, relation_type string, relation_strength string, direction string, seq long")
    got = [(r["source"], r["target"], r["strength"], r["direction"]) for r in relations.prepared(seed, firms, "seq").collect()]
    assert got == [(1, 2, 0.0, "directed")]  # both rows have one key, the later wins


def test_universe_and_failures(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿name,ts_code\nx,600000.sh\ny,000001\nz,bad\nx,600000.SH\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("000001, 430001\n600000 600000\n")
    assert [r["code"] for r in files.universe(spark, f"file://{tmp_path}/a.csv", 10).collect()] == ["600000.SH", "000001.SZ"]
    assert [r["code"] for r in files.universe(spark, f"file://{tmp_path}/b.txt", 2, 1).collect()] == ["430001.BJ", "600000.SH"]


def test_feedback_rules_and_strict_times(spark):
    table = spark.createDataFrame([("subject", "公司类", "新词", "true"), ("subject", "公司类", "旧词", "0"), ("industry", "", "x", "1")], "dimension string, label string, keyword string, enabled string")
    assert rules.feedback(table) == {"subject": {"公司类": ["新词"]}}
    with pytest.raises(Exception, match="unsupported time"):
        spark.range(1).select(T.strict_time(F.lit("soon"))).collect()


def test_missing_tables_and_presence(spark):
    assert quality.required_tables(spark, ["no_such_table"]) == ["no_such_table"]


def test_links_of_shared_names_and_tags_are_those_of_all_pairs(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rules_ = linking.LinkRules(keywords={"x": ("ka", "kb", "kc", "kd"), "other": ("ko",)}, categories={"A": "x", "B": "y"}, generic_symbols=("policy",), labels=("x", "y", "other"), other="other")
    names, tags, keywords = ("Nameone", "Nametwo", "Lonely"), ("taga", "tagb", "tagc", "tagd"), ("ka", "kb", "kc", "kd", "ko")
    some = lambda pool, k: [rng.choice(pool) for _ in range(rng.randint(0, k))]
    firms = [(i, 1000 - i, f"{i:06d}.SZ", rng.choice((*names[:2], "")) if i else names[2], rng.choice(("A1", "B1", "C1", "")), " ".join(some(keywords, 5)), some(tags, 3) if i % 9 else None if i % 2 else []) for i in range(150)]
    events = [(f"e{i}", [i], "", "", rng.choice(("x", "y", "other")), "", " ".join(some(names, 1)), " ".join(some(names, 2) + some(tags, 4) + some(keywords, 4)), rng.choice(("", "policy", f"{i:06d}"))) for i in range(80)]
    e, f = spark.createDataFrame(events, LINKS), spark.createDataFrame(firms, FIRMS)
    ev = linking.event_features(e, f, rules_).withColumn("event_industry", F.when(F.col("industry") == "x", "x").otherwise("other"))
    every = ev.join(linking.entity_features(f, rules_), "event_industry").select(
        "event_id", "entity", "place", (F.col("category") == F.col("wanted")).cast("int").alias("industry_match"), (F.substring("code", 1, 6) == F.col("symbol")).cast("int").alias("symbol_match"), F.array_contains("names", F.col("entity_name")).cast("int").alias("name_match"),
        "event_hits", "entity_hits", F.size(F.filter("tags", lambda x: F.array_contains("found_tags", x))).alias("tag_hits"), "title_hits", "specific", "generic", (F.col("generic") & (F.col("industry") == "other")).alias("generic_other"),
        (F.contains("title", F.col("entity_name")) & (F.col("entity_name") != "")).cast("int").alias("title_match"),
    )
    wanted = sorted(tuple(r) for r in linking.best_links(every, rules_, 3).select("event_id", "entity", "score", "rank", "link_type").collect())
    for frequent in (2, 50):
        monkeypatch.setattr(linking, "FREQUENT", frequent)
        got = linking.links(e, f, rules_, 3).select("event_id", "entity", "score", "rank", "link_type")
        assert sorted(tuple(r) for r in got.collect()) == wanted and len(wanted) > 100
        assert linking.candidates(e, f, rules_, 3).groupBy("event_id").count().agg(F.max("count")).first()[0] <= 3


def test_rare_tags_bring_no_entities_that_cannot_be_among_the_best(spark, monkeypatch):
    rules_ = linking.LinkRules(keywords={"x": ("ka", "kb", "kc"), "other": ("ko",)}, categories={"A": "x"}, generic_symbols=(), labels=("x", "other"), other="other")
    firms = [(i, i, f"{i:06d}.SZ", "", "A1", "ka kb kc" if i < 8 else "", [f"tagnumber{i % 8}", "unseen"]) for i in range(400)]
    events = [(f"e{i}", [i], "", "", "x", "", "", " ".join(f"tagnumber{k}" for k in range(8)), "") for i in range(30)]
    e, f = spark.createDataFrame(events, LINKS), spark.createDataFrame(firms, FIRMS)
    met, first = [], linking._first

    def counted(pairs, *rest):
        met.append(pairs.count())
        return first(pairs, *rest)

    monkeypatch.setattr(linking, "_first", counted)
    got = linking.links(e, f, rules_, 5, cut=tables.written).select("member", "entity", "rank").collect()
    assert sorted(tuple(r) for r in got) == [(i, k, k + 1) for i in range(30) for k in range(4)]  # no match by symbol or name: four links
    assert met[0] <= 30 * 20  # a tag of 50 entities brought each of them to each event
