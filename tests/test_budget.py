"""A run cut short and its resumption give the rows of one run; series as a table."""

import time

import pytest
from eventloom.operators import budget
from eventloom.sources import files
from pyspark.sql import functions as F


def test_cut_short_and_resumed(spark, tmp_path):
    rows, out, ran = spark.range(1000), f"file://{tmp_path}/out", []
    slow = F.udf(lambda x: (time.sleep(0.2), x)[1], "long")

    def work(b):
        ran.append(b)
        part = budget.bucket_of(rows, "id", 6, b)
        return part.repartition(1).limit(150).select(slow("id").alias("id")) if b == 2 and ran.count(2) == 1 else part

    assert budget.run(spark, work, out, 6, 0) == 6 and budget.results(spark, out, 6) is None and not ran
    left = budget.run(spark, work, out, 6, 12)  # bucket 2 would take half a minute
    assert left >= 1 and 2 in ran and not files.exists(spark, f"{out}/bucket=2/_SUCCESS")
    first = list(ran)
    assert budget.run(spark, work, out, 6, 600) == 0
    assert not {b for b in first if b < 2} & set(ran[len(first) :])  # finished buckets aren't done again
    assert sorted(r.id for r in budget.results(spark, out, 6).collect()) == list(range(1000))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|divide"):
        budget.run(spark, lambda b: rows.select(F.expr("id / 0")), f"{out}-bad", 1, 600)


def test_series_table(spark, tmp_path):
    path = f"file://{tmp_path}/series"
    rows = lambda *x: spark.createDataFrame(x, "key string, source string, day string, value string")
    assert files.stored_series(spark, path) is None
    files.store_series(spark, path, rows(("a", "s", "2024-01-01", "1.5"), ("a", "s", "2024-01-02", "x"), ("b", "s", "2024-01-01", "2")))
    files.store_series(spark, path, rows(("a", "t", "2024-01-01", "3"), ("a", "t", "2024-01-03", "4")))
    got = sorted(map(tuple, files.stored_series(spark, path).collect()))
    assert got == [("a", "t", "2024-01-01", 3.0), ("a", "t", "2024-01-03", 4.0), ("b", "s", "2024-01-01", 2.0)]
