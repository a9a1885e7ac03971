"""Retrieval: keyword search with aggregated partners, vector top-k for many queries, chunking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import chunks


def keyword_search(docs: DataFrame, text: str, keywords: list[str], order: list, limit: int) -> DataFrame:
    """Rows that hold a keyword in any case, the first by ``order``."""
    hit = F.lit(False)
    for k in keywords:
        hit = hit | F.col(text).ilike(f"%{k}%")
    return docs.filter(hit).orderBy(*order).limit(limit)


QUERIES, SLICE = 10_000, 256


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, id, similarity, rank): the most similar vectors of each query, others than itself.

    Queries are broadcast to the vectors' partitions in groups of about
    QUERIES, any number of groups; a task multiplies its batches with SLICE
    queries at a time and passes on the best k of each batch, so what is
    shuffled is k rows a query and batch.  Ties go to the smaller id.
    """
    groups = max(1, -(-queries.count() // QUERIES))
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups))
    parts = [_near(queries.filter(group == g) if groups > 1 else queries, vectors, k) for g in range(groups)]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return reduce(DataFrame.unionByName, parts).withColumn("rank", rank).filter(F.col("rank") <= k)


def _near(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    rows = queries.filter("q IS NOT NULL").select(F.col("query_id").cast("long"), F.col("q").cast("array<double>")).collect()
    shared = vectors.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))

    def search(batches):
        import numpy as np
        import pyarrow as pa

        ids = np.array(shared.value[0], dtype=np.int64)
        q = np.array(shared.value[1], dtype=np.float64).reshape(len(ids), -1)
        norms = np.sqrt((q * q).sum(axis=1))
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            v = flat.reshape(len(own), -1)
            lengths = np.sqrt((v * v).sum(axis=1))
            for a in range(0, len(ids) if len(own) else 0, SLICE):
                s = np.floor(q[a : a + SLICE] @ v.T / (norms[a : a + SLICE, None] * lengths + 1e-8) * 1e6 + 0.5) / 1e6
                s[ids[a : a + SLICE, None] == own] = -np.inf
                best = np.lexsort((np.broadcast_to(own, s.shape), -s), axis=1)[:, :k]
                at = np.repeat(np.arange(len(s)), best.shape[1])
                score = s[at, best.ravel()]
                keep = score > -np.inf
                columns = [pa.array(ids[a : a + SLICE][at][keep]), pa.array(own[best.ravel()][keep]), pa.array(score[keep])]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "id", "similarity"])

    plain = vectors.filter("v IS NOT NULL").select(F.col("id").cast("long"), F.col("v").cast("array<double>"))
    return plain.mapInArrow(search, "query_id long, id long, similarity double")


def chunked(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, chunk, content): each text's lines packed into chunks."""
    return docs.select(key, F.posexplode(chunks(F.col(text), size)).alias("chunk", "content"))


def partners(links: DataFrame, names: DataFrame) -> DataFrame:
    """(event_id, partners): distinct names of an event's entities, sorted and joined."""
    return links.join(names, "entity").groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("partners"))


def search_events(events: DataFrame, names: DataFrame, columns: list[str], keywords: list[str], order: list, limit: int) -> DataFrame:
    """Events with a keyword in one of some columns, the first by ``order``, with the joined names of their entities."""
    hit = F.lit(False)
    for c in columns:
        for k in keywords:
            hit = hit | F.col(c).ilike(f"%{k}%")
    found = events.filter(hit).orderBy(*order).limit(limit)
    by = names.join(found.select("event_id"), "event_id", "left_semi").groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("partners"))
    return found.join(by, "event_id", "left").withColumn("partners", F.coalesce("partners", F.lit("")))


def indexed(docs: DataFrame, key: str, text: str, size: int, embed=None) -> DataFrame:
    """(key, chunk, content, embedding): chunks to be written as an index; ``embed`` is a column function from text to vector."""
    found = chunked(docs, key, text, size)
    return found.withColumn("embedding", embed(F.col("content")) if embed is not None else F.lit(None).cast("array<float>"))
