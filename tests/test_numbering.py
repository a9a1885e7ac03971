"""Places in an order are exact at any number of ranges, whatever columns are read."""

import pytest
from eventloom.operators import documents, upsert
from pyspark.sql import functions as F


@pytest.mark.parametrize("ranges", [4, 16, 200])
def test_places_of_many_rows(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        n = 3_000_000 if ranges == 16 else 200_000
        rows = spark.range(n).select((F.col("id") * 7_919 % 1_000_003 + F.col("id") * 1_000_003).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.rand(3).alias("place"))
        rows = rows.repartition(7)
        found = upsert.numbered(rows, "key", "at")
        assert found.columns == ["key", "text", "place", "at"]
        check = found.agg(F.count(F.lit(1)), F.countDistinct("at"), F.min("at"), F.max("at"), F.countDistinct("key")).first()
        assert tuple(check) == (n, n, 0, n - 1, n)
        # the order is the key's: keys rise with places, so both have the same extremes in every thousandth of places
        ends = found.groupBy(F.floor(F.col("at") / (n // 1000)).alias("g")).agg(F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("g").collect()
        assert all(a.hi < b.lo for a, b in zip(ends, ends[1:]))
        shards = [upsert.sharded(rows, "key", 3, k) for k in range(3)]
        union = shards[0].unionByName(shards[1]).unionByName(shards[2])
        assert union.columns == rows.columns and tuple(union.agg(F.count(F.lit(1)), F.countDistinct("key")).first()) == (n, n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_batches_edges(spark):
    rows = spark.createDataFrame([(3, "c", 1), (1, "a", 2), (None, "n", 3), (2, "b", 4), (2, "b", 4)], "id int, place string, range int")
    found = documents.batches(rows, "id", 2)
    assert found.columns == ["id", "place", "range", "batch"]
    assert sorted((r.batch, r.id or 0) for r in found.collect()) == [(0, 0), (0, 1), (1, 2), (1, 2), (2, 3)]
    assert documents.batches(rows.limit(0), "id", 2).count() == 0
