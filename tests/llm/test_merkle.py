"""Operator 12 against a plain Merkle tree, with its proofs."""

import hashlib
import zlib

import pytest
from eventloom.llm import merkle
from pyspark.sql import functions as F

DOC = "doc_id long, source string, lang string, n_chars long, text string, leaf string, g string, pos long, key string"


def h(*xs):
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf_of(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        yield i, level[i ^ 1] if (i ^ 1) < len(level) else None
        i >>= 1


def brute(docs):
    """Sorted result rows of (doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        rows = sorted(groups[lang], key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(*d)))
        trees[lang] = rows, levels_of([leaf_of(*d) for d in rows])
    top = levels_of([trees[x][1][-1][0] for x in order]) if order else []
    out = []
    for k, lang in enumerate(order):
        rows, levels = trees[lang]
        for i, d in enumerate(rows):
            path = [*siblings(levels, i), *siblings(top, k)]
            now = d
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[3] is not None:
                now = (*d[:3], d[3] + 1, d[4])
            at = leaf_of(*now)
            for at_i, s in path:
                at = h(at) if s is None else h(s, at) if at_i & 1 else h(at, s)
            out.append((d[0], leaf_of(*d), levels[-1][0], top[-1][0], h(*(s or "" for _, s in path)), at, at == top[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in merkle.op12_merkle_manifest(df).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x") for r in rows], DOC)


@pytest.mark.parametrize("step", [2, 8])
def test_equals_a_plain_tree(spark, step):
    rows = []
    for lang, n in ((None, 1), ("de", 1), ("en", 37), ("fr", 2), ("", 5), ("zh", 3), ("é", 4), ("z", 16)):
        rows += [(len(rows) * 3 - 7, "s" if i % 3 else None, lang, i if i % 5 else None, None if i % 4 == 0 else "t" * i + "é") for i in range(n)]
    rows += [rows[10], rows[10], (None, None, None, None, None), (rows[20][0], "other", "en", 3, "tie")]
    digest = merkle.leaf(*(F.col(c) for c in merkle.FIELDS))
    found = merkle.manifest(table(spark, rows), "doc_id", "lang", digest, siblings=True, step=step).collect()
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in found if r.doc_id is not None) == sorted(r[:5] for r in brute(rows) if r[0] is not None)
    assert len(found) == len(rows) and all(merkle.folded(r.leaf, r.siblings) == r.root == r.folded_root for r in found)
    if step == merkle.STEP:
        assert result(table(spark, rows)) == brute(rows)


def test_small_and_empty_tables(spark):
    for rows in ([], [(1, "s", "en", 1, "a")], [(1, "s", "en", 1, "a"), (2, "s", None, None, "")], [(8, None, None, 5, None)] * 3):
        assert result(table(spark, rows)) == brute(rows)


def test_many_groups_and_long_texts(spark):
    rows = [(i, "s", f"l{i % 300:03d}", i, "word " * 300_000 if i == 5 else str(i)) for i in range(900)]
    assert result(table(spark, rows)) == brute(rows)


def test_given_documents_and_siblings(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert result(docs) == want and any(not r[-1] for r in want)
    digest = merkle.leaf(*(F.col(c) for c in merkle.FIELDS))
    found = merkle.manifest(docs, "doc_id", "lang", digest, siblings=True).collect()
    assert all(merkle.folded(r.leaf, r.siblings) == r.root == r.folded_root for r in found) and len(found) == len(want)


def test_only_every_few_levels_are_stored(spark):
    from eventloom.llm.common import Scratch

    leaves = spark.range(70_000).select(F.lit("=a").alias("g"), F.col("id").alias("pos"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    tree = merkle.build(leaves, Scratch(spark, "test"))
    assert [t.count() for t in tree.levels] == [70_000, 274, 2, 1, 1]
    assert tree.roots()[-1][1].first().root == levels_of([r.digest for r in leaves.orderBy("pos").collect()])[-1][0]
