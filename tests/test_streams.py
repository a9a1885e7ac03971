"""Streams over files: flushes, streaks, recomputed snapshots, rows of the future."""

import datetime as dt

import pytest
from eventloom.operators import daily
from eventloom.streaming import jobs
from eventloom.streaming.buckets import Buckets
from pyspark.sql import functions as F

SCHEMA = "k long, url string, ts timestamp, seq long"


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_flushes_upsert_with_late_rows(spark, tmp_path):
    src, out, cp = (f"file://{tmp_path}/{n}" for n in ("src", "out", "cp"))
    t = lambda d: dt.datetime(2024, 1, d)
    put(spark, src, [(1, "a", t(5), 1), (2, "b", t(5), 2), (3, "a", t(6), 3)])
    past = lambda df: jobs.of_the_past(df, "ts", "2024-01-10")
    jobs.flush_stream(read(spark, src), "url", "seq", out, cp, past, rows_per_flush=2).awaitTermination()
    put(spark, src, [(4, "b", t(1), 4), (5, "c", t(30), 5), (6, "d", t(7), 6)])
    jobs.flush_stream(read(spark, src), "url", "seq", out, cp, past, rows_per_flush=2).awaitTermination()
    assert {(r["url"], r["k"]) for r in jobs.stored(spark, out, "url").collect()} == {("a", 3), ("b", 4), ("d", 6)}
    assert jobs.stored(spark, f"{out}-none", "url") is None


def test_streaks(spark, tmp_path):
    src, out, cp = (f"file://{tmp_path}/{n}" for n in ("src", "out", "cp"))
    days = [("a", 1), ("a", 2), ("a", 3), ("a", 6), ("b", 2), ("b", 4)]
    put(spark, src, [(i, u, dt.datetime(2024, 1, d, 9 + i), i) for i, (u, d) in enumerate(days)])
    put(spark, src, [(9, "z", dt.datetime(2024, 3, 1), 9)])  # moves the watermark
    put(spark, src, [(10, "z", dt.datetime(2024, 3, 2), 10)])
    found = jobs.daily_streaks(read(spark, src), "ts", "url")
    found.writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    got = {(r["url"], str(r["first_day"]), r["days"]) for r in spark.read.parquet(out).collect()}
    assert {g for g in got if g[0] != "z"} == {("a", "2024-01-01", 3), ("a", "2024-01-06", 1), ("b", "2024-01-02", 1), ("b", "2024-01-04", 1)}


def test_late_rows_change_the_snapshot(spark, tmp_path):
    src, out, cp = (f"file://{tmp_path}/{n}" for n in ("src", "out", "cp"))
    count = lambda df: daily.cluster_totals(df.select(F.col("k").alias("cluster"), F.to_date("ts").alias("day"), F.col("url").alias("source"))).withColumnRenamed("cluster", "k")
    put(spark, src, [(1, "a", dt.datetime(2024, 1, 5), 1), (2, "a", dt.datetime(2024, 1, 5), 1)])
    jobs.recomputed(read(spark, src), ["k"], count, out, cp, 8).awaitTermination()
    put(spark, src, [(1, "b", dt.datetime(2023, 12, 5), 2)])
    jobs.recomputed(read(spark, src), ["k"], count, out, cp, 8).awaitTermination()
    got = {(r["k"], r["reports"], r["media"], str(r["first_day"])) for r in jobs.current_snapshot(spark, out, ["k"], 8).collect()}
    assert got == {(1, 2, 2, "2023-12-05"), (2, 1, 1, "2024-01-05")}


def test_buckets_rewrite_what_they_touch_and_survive_a_killed_run(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    table = Buckets(spark, path, ["k"], 8)
    upsert = lambda old, new: new if old is None else old.join(new.select("k"), "k", "left_anti").unionByName(new)
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "k long, v long")
    table.update(0, rows(range(100), 0), upsert)
    before = table.current()
    table.update(1, rows([3], 1), upsert)
    after = table.current()
    assert sum(before[b] != after[b] for b in before) == 1 and table.read().count() == 100 and table.read().agg(F.sum("v")).first()[0] == 1

    def killed(old, new):
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        table.update(2, rows(range(50), 9), killed)
    rows(range(50), 9).withColumn("_bucket", table.of()).write.partitionBy("_bucket").parquet(f"{path}/data/v=2")  # as if killed after the data
    assert table.read().agg(F.sum("v")).first()[0] == 1
    table.update(2, rows(range(50), 2), upsert)
    table.update(2, rows(range(50), 2), upsert)  # the same batch again
    assert table.read().count() == 100 and table.read().agg(F.sum("v")).first()[0] == 100
    table.update(3, rows([], 2), upsert)
    table.vacuum()
    assert table.versions() == [2, 3] and table.read().count() == 100
    assert Buckets(spark, f"{path}-none", ["k"], 8).read() is None


def test_classified_once_without_reading_what_is_stored(spark, tmp_path):
    src, out, cp = (f"file://{tmp_path}/{n}" for n in ("src", "out", "cp"))
    label = lambda df: df.withColumn("label", F.lit("x"))
    put(spark, src, [(1, "a", dt.datetime(2024, 1, 5), 1), (2, "b", dt.datetime(2024, 1, 5), 2), (3, "a", dt.datetime(2024, 1, 5), 3)])
    jobs.classify_stream(read(spark, src), label, out, cp).awaitTermination()
    put(spark, src, [(4, "a", dt.datetime(2024, 1, 6), 4), (5, "c", dt.datetime(2024, 1, 6), 5)])
    jobs.classify_stream(read(spark, src), label, out, cp).awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_daily_counts_and_first_urls(spark, tmp_path):
    src, cp = (f"file://{tmp_path}/{n}" for n in ("src", "cp"))
    put(spark, src, [(1, "a", dt.datetime(2024, 1, 5), 1), (2, "a", dt.datetime(2024, 1, 5, 2), 2), (3, "b", dt.datetime(2024, 1, 5), 3)])
    put(spark, src, [(4, "z", dt.datetime(2024, 2, 5), 4)])
    put(spark, src, [(5, "y", dt.datetime(2024, 3, 5), 5)])
    for name, df in (("counts", jobs.daily_counts(read(spark, src), "ts", "url")), ("first", jobs.first_by_url(read(spark, src), "ts"))):
        df.writeStream.format("parquet").option("path", f"file://{tmp_path}/{name}").option("checkpointLocation", f"{cp}-{name}").trigger(availableNow=True).start().awaitTermination()
    counts = {(r["url"], r["n"]) for r in spark.read.parquet(f"file://{tmp_path}/counts").collect()}
    assert {("a", 2), ("b", 1)} <= counts
    urls = [r["url"] for r in spark.read.parquet(f"file://{tmp_path}/first").collect()]
    assert len(urls) == len(set(urls)) and {"a", "b", "z", "y"} <= set(urls)
