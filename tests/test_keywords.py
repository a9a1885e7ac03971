"""The automaton's keywords against a scan for each word."""

import random

from eventloom.functions import text as T
from eventloom.functions.keywords import Scan, scanner, words_of
from eventloom.operators import rules, structured
from pyspark.sql import functions as F


def test_scans_equal_contains(spark):
    rng = random.Random(6)
    words = ["ab", "abc", "b", "bca", "公告", "公告书", "a公", "", "zz", "AB", "c a"]
    texts = ["".join(rng.choice(["a", "b", "c", "公", "告", "书", " ", "A", "B"]) for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("w", scanner(words)(F.array("t")))
    found, t = Scan(F.col("w")[0]), F.col("t")
    rules_of = {"x": ["ab", "公告"], "y": ["b", "bca", "zz"], "z": ["AB", "AB", "c a"], "none": []}
    both = lambda f: (f(t), f(found))
    columns = [
        both(lambda x: T.hits(x, words)), both(lambda x: T.hits(x, ["b", "ab", "b"])), both(lambda x: T.n_hits(x, words[1:])), both(lambda x: T.any_hit(x, ["zz", "公告书"])), both(lambda x: T.any_hit(x, [])),
        both(lambda x: T.first_label(x, list(rules_of.items()), "d")), both(lambda x: T.best_rule(x, rules_of, "d")), both(lambda x: ~T.any_hit(x, ["b"])),
    ]
    for k, (plain, scanned) in enumerate(columns):
        different = df.filter(~plain.eqNullSafe(scanned)).select("t", plain, scanned).collect()
        assert not different, (k, different[:3])


def test_words_of_packs():
    words = words_of(rules.PUBLISHED) | words_of(structured.PUBLISHED)
    assert {"公告", "储能", "股份冻结", "停牌"} <= words and words_of({"a": ("b", ["c"])}) == {"a", "b", "c"} and words_of(7) == set()
    assert len(structured.PUBLISHED.subtype) == 19 and len(rules.PUBLISHED.industry) == 4
