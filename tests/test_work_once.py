"""Costly steps over texts stand once in a plan."""

import random
import re

from eventloom.functions.keywords import scanner
from eventloom.operators import entities, samples, structured
from eventloom.plans import registry, structured_queries
from pyspark.sql import functions as F


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "10000")
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_structured_reads_entities_and_amounts_once(spark, sf):
    plan = _plan(registry.QUERIES["structured_rows"](spark, sf))
    assert plan.count(f", {structured.NEUTRAL.entity.pattern}, ") == 1
    assert len(re.findall(r"regexp_extract_all\([^,]*, \(", plan)) == 1


def test_enrichment_needs_no_join_with_its_documents(spark, sf):
    plan = _plan(registry.QUERIES["enriched_events"](spark, sf))
    assert "Join " not in plan  # nor with the counts of duplicates, which it does not read


def test_validation_decides_once(spark, sf):
    plan = _plan(registry.QUERIES["validation_checks"](spark, sf))
    assert plan.count("ArrowEvalPython") == 1  # the words of the events' labels


def test_joined_scans_equal_scans_of_joined_texts(spark):
    rng = random.Random(3)
    words = ["ab", "a b", "b c a", " a", "a ", "b a b", "公 告", "c", ""]
    text = lambda: rng.choice([None, *("".join(rng.choice("abc公告 ") for _ in range(rng.choice([0, 1, 3, 9, 14]))) for _ in range(6))])
    df = spark.createDataFrame([(i, text(), text(), text(), text()) for i in range(400)], "i int, a string, b string, c string, d string")
    one = df.select("*", scanner(words, joined=3)(F.array("a", "b", "c", "d")).alias("w"), scanner(words)(F.array("a", "b", "c", "d", F.concat_ws(" ", "a", "b", "c"))).alias("v"))
    same = lambda c, k: F.array_sort(F.col(c)[k]).eqNullSafe(F.array_sort(F.col("v")[k]))
    at = (0, 1, 2, 3, 4)
    assert one.filter(~(same("w", 0) & same("w", 1) & same("w", 2) & same("w", 3) & same("w", 4)) | (F.size("w") != len(at))).count() == 0


def test_entities_are_those_of_cleaning_each_candidate(spark):
    texts = ["：某银行， 关于银行 某银行。", "ST 600000.SH [600000.SH]", "", "）（", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    clean = "^[：:，。；;（）()\\[\\]【】]+|[：:，。；;（）()\\[\\]【】]+$"
    bare = F.regexp_replace(F.regexp_replace("t", "(?U)\\s+", ""), clean, "")
    ok = F.length(bare).between(2, 24) & ~bare.startswith("关于")
    rules = entities.EntityRules(pattern="x", prefixes=("关于",))
    assert df.filter(~F.when(ok, bare).eqNullSafe(entities.entity(F.col("t"), rules))).count() == 0


def test_samples_read_links_once(spark, sf):
    plan = _plan(registry.QUERIES["event_samples"](spark, sf))
    assert plan.count("o_orderkey") and len(re.findall(r"Relation \[o_orderkey", plan)) == 1
    assert "LeftOuter" not in plan  # labels meet events in the sort that features need


def test_samples_count_entities_and_groups_of_all_links(spark):
    import datetime as dt

    day = dt.date(2024, 1, 3)
    links = spark.createDataFrame([(1, 5, day, 0.9, "a"), (1, 5, day, 0.4, "b"), (1, 6, day, 0.5, ""), (1, 7, day, 0.1, "c"), (1, None, day, 0.6, None), (2, 5, None, 0.8, "a")], "event_id long, entity long, event_date date, score double, group string")
    features = spark.createDataFrame([(5, dt.date(2024, 1, 1), 1.5), (6, dt.date(2024, 1, 4), 2.5)], "entity long, day date, turnover double")
    labels = spark.createDataFrame([(5, dt.date(2024, 1, 2), 0.1), (5, day, 0.2), (6, dt.date(2024, 1, 2), 0.3), (None, day, 0.4)], "entity long, day date, forward double")
    got = {(r["event_id"], r["entity"]): (r["score"], r["affected_entities"], r["affected_groups"], r["f"] and r["f"]["turnover"], r["forward"]) for r in samples.event_samples(links, features, labels).collect()}
    assert got == {(1, 5): (0.4, 2, 2, 1.5, 0.2), (1, 6): (0.5, 2, 2, None, None), (1, None): (0.6, 2, 2, None, None), (2, 5): (0.8, 1, 1, None, None)}


def test_companies_take_their_words_before_they_meet_documents(spark, sf):
    plan = _plan(structured_queries._companies(spark, sf))
    assert plan.index("Join ") < plan.index("regexp_extract(")  # read below the join, so no text is shuffled
