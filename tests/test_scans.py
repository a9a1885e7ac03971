"""Scans by hand-made cases: profiles, upserts by source, stale rows, suspension words, malformed search results."""

from eventloom.operators import scans
from eventloom.sources import variants
from pyspark.sql import functions as F


def test_published_profiles(spark):
    rows = scans.source_profiles(spark).collect()
    assert len({r.history_source for r in rows}) == 14 and len(rows) == 20
    assert {r.history_source for r in rows} - {r.history_source for r in scans.source_profiles(spark, True).collect()} == {"cninfo-disclosure", "cninfo-latest"}
    docs = spark.createDataFrame([("第一财经", True), ("第一财经/要闻", False), ("深交所/停复牌公告", False), (None, True)], "source string, good boolean")
    got = {r.history_source: (r.rows, r.body_rows, r.gap, r.runs) for r in scans.source_progress(docs, F.col("good")).collect()}
    assert got["yicai-news"] == (2, 1, 1999, True) and got["szse-suspension"] == (1, 0, 1999, True) and got["cninfo-latest"] == (0, 0, 0, True)


def test_profile_upsert_by_source(spark):
    names = ["company_name", "exchange", "industry_l1", "industry_l2", "concept_tags", "region", "list_date", "state_owned_flag", "company_type", "business_scope", "core_products", "main_customers", "main_suppliers", "employees", "total_shares", "float_shares", "data_source"]
    row = lambda code, **kw: (code, "2024-01-01", *(kw.get(n) for n in names))
    schema = ", ".join(f"{c} string" for c in ("ts_code", "snapshot_date", *names))
    old = spark.createDataFrame([row("a", company_name="A", region="r", main_customers='["x"]', main_suppliers="[]", data_source="api"), row("b", company_name="B", main_customers='["x"]', data_source="api"), row("c", company_name="C", data_source="api")], schema)
    new = spark.createDataFrame([row("a", company_name="A2", main_customers="[]", main_suppliers='["y"]', data_source="companies_table"), row("b", main_customers="[]", region="q", data_source="seed"), row("d", company_name="D", data_source="companies_table")], schema)
    got = {r.ts_code: r for r in scans.profiles_upserted(old, new).collect()}
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.company_name, a.region, a.main_customers, a.main_suppliers, a.data_source) == ("A2", "r", '["x"]', '["y"]', "api")
    assert (b.company_name, b.region, b.main_customers, b.data_source) == (None, "q", "[]", "seed")
    assert (c.company_name, c.data_source, d.company_name, d.data_source) == ("C", "api", "D", "companies_table")


def test_stale_rows_suspension_and_reasons(spark):
    rows = lambda *ids: spark.createDataFrame([(i, i % 2) for i in ids], "k long, g long")
    assert sorted(r.k for r in scans.stale(rows(1, 2, 3), rows(2, 5), ["k"]).collect()) == [1, 3]
    words = spark.createDataFrame([("关于停牌的公告", None), (None, "复牌"), ("年报", "其他")], "t string, c string")
    assert [r.s for r in words.select(scans.suspension(F.col("t"), F.col("c")).alias("s")).collect()] == [True, True, False]
    outcomes = spark.createDataFrame([("short",), ("short",), ("gap",), ("",), (None,), ("cap",)], "reason string")
    assert [(r.reason, r.rows) for r in scans.latest_reasons(outcomes, 2).orderBy("rank").collect()] == [("short", 2), ("cap", 1)]


def test_search_results_of_other_shapes(spark):
    pages = [
        (1, '{"data":{"searchResult":{"dataResults":[{"title":"<b>A</b>","infocontent":"x &amp; y","createdate":"1704067200000"},{"title":"","infocontent":"no title"},{"title":"B"},7,null,{"groupData":[],"title":"C","infocontent":"c"}]}}}'),
        (2, '{"data":{"searchResult":{"dataResults":"none"}}}'), (3, "{bad"), (4, None), (5, "{}"),
        (6, '{"data":{"searchResult":{"dataResults":[{"title":"D","infoextends":"{\\"elementList\\":[{\\"fieldName\\":\\"content\\",\\"fieldValue\\":\\"d\\"},{\\"fieldName\\":\\"content\\",\\"fieldValue\\":\\"e\\"}]}","infocontent":"z","url":"http://a/b"}]}}}'),
    ]
    got = sorted(map(tuple, variants.search_items(spark.createDataFrame(pages, "page long, payload string"), "payload").collect()))
    assert got == [(1, "A", "2024-01-01 00:00:00", "x & y", ""), (1, "C", "", "c", ""), (6, "D", "", "d", "http://a/b")]
