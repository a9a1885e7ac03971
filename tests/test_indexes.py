"""The vector index by recall against exact ranking, the keyword index against a scan."""

import numpy as np
import pytest
from eventloom.operators import keyword_index, retrieval, vector_index
from pyspark.sql import functions as F


@pytest.mark.parametrize("shape", ["clusters", "noise"])
def test_vector_index_recall(spark, shape):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(4000, 16)) + (rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] * 4 if shape == "clusters" else 0)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(4000, None), (4001, [0.0] * 16)], "id long, v array<double>")
    index = vector_index.build(rows, sample_rows=2000)
    assert index.lists.count() == 4000 and index.lists.select("id").distinct().count() == 4000 and index.lists.select("cell").distinct().count() > 30
    queries = rows.filter("id % 20 = 0 AND v IS NOT NULL").select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    exact = retrieval.top_k(queries, rows.filter("id < 4000")).cache()
    found = vector_index.search(index, queries)
    assert vector_index.recall(found, exact) >= 0.9
    if shape == "clusters":
        assert index.probes < len(index.centroids) / 4
    whole = vector_index.search(index, queries, probes=len(index.centroids))
    assert sorted(map(tuple, whole.select("query_id", "id", "rank").collect())) == sorted(map(tuple, exact.select("query_id", "id", "rank").collect()))


def test_vector_index_on_given_vectors(spark, sf):
    e = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/embeddings.parquet")
    vectors = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    queries = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    assert vector_index.recall(vector_index.search(vector_index.build(vectors), queries), retrieval.top_k(queries, vectors)) >= 0.9
    empty = vector_index.build(vectors.limit(0))
    assert vector_index.search(empty, queries).count() == 0


def test_text_embeddings(spark):
    docs = spark.createDataFrame([(1, "the bank raised its loan rate"), (2, "the bank raised the loan rate again"), (3, "steel output fell in the north"), (4, None), (5, "")], "id long, text string")
    embed = vector_index.text_embedder(docs, "text")
    made = retrieval.indexed(docs, "id", "text", 400, embed).select("id", F.col("embedding").alias("v"))
    assert {r.id for r in made.collect()} == {1, 2, 3}
    near = retrieval.top_k(made.select(F.col("id").alias("query_id"), F.col("v").alias("q")), made, 1)
    best = {r.query_id: r.id for r in near.collect()}
    assert best[1] == 2 and best[2] == 1
    zero = docs.filter("id >= 4").select(embed(F.col("text")).alias("v")).collect()
    assert all(len(r.v) == 256 and not any(r.v) for r in zero)


def test_keyword_index_equals_a_scan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("content"))
    index = keyword_index.build(docs, "doc_id", ["title", "content"])
    for words in (["License"], ["stupid", "LICENSE"], ["the"], ["ab"], ["a_d"], ["ation%the"], ["nothing of this kind"], ["über"], ["100%"], []):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.col("title").ilike(f"%{w}%") | F.col("content").ilike(f"%{w}%")
        assert sorted(r.doc_id for r in keyword_index.search(index, docs, words).collect()) == sorted(r.doc_id for r in docs.filter(hit).collect()), words
    plan = keyword_index.candidates(index, "License")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(gram" in plan or "In(gram" in plan


def test_keyword_index_shuffles_postings_once(spark):
    """Keys that repeat are found, and postings are dealt out once: no pass before for distinct rows or for ranges."""
    docs = spark.createDataFrame([(1, "the bank raised"), (1, "a bank"), (2, "steel"), (3, None)], "id long, text string")
    spark.sparkContext.setJobGroup("postings", "postings")
    index = keyword_index.build(docs, "id", ["text"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("postings")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 4
    assert sorted(r.text for r in keyword_index.search(index, docs, ["bank"]).collect()) == ["a bank", "the bank raised"]
