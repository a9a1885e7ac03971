"""An inverted-file index over vectors: a coarse quantiser, lists by cell, exact ranking of the lists that a query probes.

The quantiser is fitted on a sample of about ``sample_rows`` rows; every row
lies in one list.  ``probes`` is the least number of lists by which queries from
the sample find ``recall`` of their exact nearest neighbours in the sample.
``retrieval.top_k`` is the exact way.

Edges: null vectors and those without length aren't indexed; equal scores go to
the smaller id; an empty table gives an index without lists.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .retrieval import QUERIES
from .tables import written

#: Bytes of centroids that are broadcast at most.
CENTROIDS = 64 << 20


@dataclass
class VectorIndex:
    """Lists (cell, id, v) in order of their cells, the cells' centroids, and how many of them a query probes."""

    lists: DataFrame
    centroids: np.ndarray
    probes: int


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _quantiser(sample: np.ndarray, cells: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids of spherical k-means over unit vectors; a cell that runs empty starts anew at the vector that is farthest from its own."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), cells, replace=False)]
    for _ in range(rounds):
        similar = sample @ centroids.T
        own = similar.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=cells) == 0)
        if len(empty):
            sums[empty] = sample[np.argsort(similar.max(axis=1))[: len(empty)]]
        centroids = _unit(sums)
    return centroids


def _probes(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> int:
    """The least number of cells in which a sample's queries find so much of their nearest neighbours."""
    own = (sample @ centroids.T).argmax(axis=1)
    asked = rng.choice(len(sample), min(500, len(sample)), replace=False)
    similar = sample[asked] @ sample.T
    similar[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-similar, axis=1)[:, : min(k, len(sample) - 1)]
    order = np.argsort(-(sample[asked] @ centroids.T), axis=1)
    place = np.argsort(order, axis=1)  # of each cell in the query's order
    needed = np.sort(place[np.arange(len(asked))[:, None], own[near]].ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1 if len(needed) else 1


def build(vectors: DataFrame, cells: int | None = None, sample_rows: int = 20_000, k: int = 5, recall: float = 0.95, rounds: int = 12, seed: int = 7) -> VectorIndex:
    """An index of rows (id, v); ``cells`` is about the square root of the rows, 4,096 at most, if not given."""
    rows = vectors.filter("v IS NOT NULL").select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    rows = rows.filter(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) > 0)
    n = rows.count()
    drawn = F.xxhash64(F.lit(seed), "id").bitwiseAND((1 << 40) - 1) / float(1 << 40)
    kept = rows.filter(drawn < min(1.0, sample_rows / max(n, 1))).orderBy("id").select("v").collect()  # about sample_rows
    if not kept:
        return VectorIndex(rows.withColumn("cell", F.lit(0)), np.zeros((0, 1)), 0)
    sample = _unit(np.array([r.v for r in kept]))
    cells = max(1, min(cells or int(n**0.5), 4096, len(sample), CENTROIDS // (8 * sample.shape[1])))
    centroids = _quantiser(sample, cells, rounds, seed)
    probes = _probes(sample, centroids, k, recall, np.random.default_rng(seed))
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches):
        for batch in batches:
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            cell = (_unit(v) @ shared.value.T).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", "id", "v"])

    placed = rows.mapInArrow(assign, "cell int, id long, v array<double>")
    # ranges of (cell, id): a crowded cell spreads over many files, and a file's statistics tell which cells it has
    return VectorIndex(written(placed.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id"), "vectors"), centroids, probes)


def search(index: VectorIndex, queries: DataFrame, k: int = 5, probes: int | None = None) -> DataFrame:
    """(query_id, id, similarity, rank): the best of the lists that each query (query_id, q) probes, others than itself.

    Queries are broadcast in groups of about QUERIES, as by ``retrieval.top_k``.
    """
    asked = queries.filter("q IS NOT NULL")
    groups = max(1, -(-asked.count() // QUERIES))
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups))
    parts = [_ranked(index, asked.filter(group == g), k, probes or index.probes) for g in range(groups)]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return reduce(DataFrame.unionByName, parts).withColumn("rank", rank).filter(F.col("rank") <= k)


def _ranked(index: VectorIndex, queries: DataFrame, k: int, probes: int) -> DataFrame:
    rows = queries.select(F.col("query_id").cast("long"), F.col("q").cast("array<double>")).collect()
    schema = "query_id long, id long, similarity double"
    if not rows or not len(index.centroids):
        return queries.sparkSession.createDataFrame([], schema)
    ids, q = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    best = np.argsort(-(_unit(q) @ index.centroids.T), axis=1, kind="stable")[:, :probes]
    by_cell: dict[int, np.ndarray] = {}
    flat, of = best.ravel(), np.repeat(np.arange(len(ids)), best.shape[1])
    order = np.argsort(flat, kind="stable")
    cells, starts = np.unique(flat[order], return_index=True)
    for cell, part in zip(cells.tolist(), np.split(of[order], starts[1:])):
        by_cell[cell] = part
    shared = queries.sparkSession.sparkContext.broadcast((ids, q, by_cell))

    def rank(batches):
        ids, q, by_cell = shared.value
        norms = np.linalg.norm(q, axis=1)
        for batch in batches:
            cell, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            v = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
            lengths = np.linalg.norm(v, axis=1)
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:]):
                asking = by_cell.get(int(cell[a])) if b > a else None
                if asking is None:
                    continue
                s = np.floor(q[asking] @ v[a:b].T / (norms[asking, None] * lengths[a:b] + 1e-8) * 1e6 + 0.5) / 1e6
                s[ids[asking, None] == own[a:b]] = -np.inf
                top = np.lexsort((np.broadcast_to(own[a:b], s.shape), -s), axis=1)[:, :k]
                at = np.repeat(np.arange(len(s)), top.shape[1])
                score, keep = s[at, top.ravel()], s[at, top.ravel()] > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(ids[asking][at][keep]), pa.array(own[a:b][top.ravel()][keep]), pa.array(score[keep])], names=["query_id", "id", "similarity"])

    return index.lists.filter(F.col("cell").isin(*cells.tolist())).select("cell", "id", "v").mapInArrow(rank, schema)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact neighbours that were found."""
    row = exact.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0)))).first()
    return row[0] if row[0] is not None else 1.0


def text_embedder(docs: DataFrame, text: str, size: int = 256):
    """A column function from text to a unit vector of hashed TF-IDF words, fitted on all of ``docs``.

    A word adds its inverse document frequency, with a sign by its hash, to its
    bucket; the driver gets a count for each of ``size`` buckets.  A text without
    words gives zeros.
    """
    tokens = lambda c: F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    bucket = lambda w: F.pmod(F.xxhash64(w), F.lit(size)).cast("int")
    n = docs.count()
    counts = docs.select(F.explode(F.array_distinct(F.transform(tokens(F.col(text)), bucket))).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
    weight = np.full(size, np.log(n + 1.0))
    for r in counts:
        weight[r.b] = np.log((n + 1) / (r.n + 0.5))

    @F.arrow_udf("array<double>")
    def embed(slots: pa.Array) -> pa.Array:
        flat, offsets = slots.values.to_numpy(zero_copy_only=False), slots.offsets.to_numpy()
        out = np.zeros((len(slots), size))
        row = np.repeat(np.arange(len(slots)), np.diff(offsets))
        flat = flat[offsets[0] : offsets[-1]]
        np.add.at(out, (row, np.abs(flat) - 1), np.where(flat > 0, 1.0, -1.0) * weight[np.abs(flat) - 1])
        return pa.ListArray.from_arrays(pa.array(np.arange(0, (len(slots) + 1) * size, size, dtype=np.int32)), pa.array(_unit(out).ravel()))

    signed = lambda w: (bucket(w) + 1) * F.when(F.xxhash64(F.lit("sign"), w) < 0, -1).otherwise(1)
    return lambda c: embed(F.transform(tokens(c), signed))
