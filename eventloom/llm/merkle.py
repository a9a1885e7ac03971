"""Operator 12: a Merkle manifest of a dataset, with proofs from few stored nodes.

Leaves are numbered within their group, so a node's place in the tree follows
from its leaf's number.  Only every ``step``-th level is written.  Going up, a
task folds each aligned subtree of 2**step stored nodes into the next stored
one.  Going down, it makes the subtree's interior nodes again from the stored
ones below it, gives each of them its siblings on the way to the root, and
forgets the interior.  The groups' roots are the leaves of one more such tree.

A node over a run of two, or of one at the right end, is H of their digests;
a level of one node ends its tree.  H is the lowercase hex SHA-256 of its
inputs in a row.

Edges: nulls in any column are a leaf's ``-``; a null group comes first, then
groups by their UTF-8 bytes.  Rows with equal keys are ordered by their leaves'
digests, repeated rows keep a leaf each.  An empty table has no rows and no
root.  Texts of any length are hashed where they are read and never moved.
Extra columns aren't part of a leaf and may have any name.  A null key counts as
not divisible, so that row isn't tampered with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .common import Scratch, crc_mod, numbered

#: Levels between stored ones: subtrees of 256 nodes.
STEP = 8
#: Columns of a leaf, in its order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*digests: str) -> str:  # noqa: N802
    """Lowercase hex SHA-256 of some strings in a row."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf(*values: Column) -> Column:
    """A leaf's digest: ``-`` for null, else the value's UTF-8 bytes' count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def _climb(digests: list[str], levels: int) -> Iterator[list[str]]:
    """The levels above some neighbouring nodes."""
    for _ in range(levels):
        digests = [H(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
        yield digests


def _height(n: int) -> int:
    """Levels over n nodes up to a single one."""
    return (n - 1).bit_length()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[dict]]]:
    """(group, block, rows) of rows that are sorted by them; a block has 2**step rows and a path's at most."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["g"], row["block"]) != key:
                if rows:
                    yield *key, rows
                key, rows = (row["g"], row["block"]), []
            rows.append(row)
    if rows:
        yield *key, rows


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about four thousand."""
    kept = []
    for row in rows:
        kept.append(row)
        if len(kept) == 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)
            kept = []
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)


NODE = "g string, pos bigint, digest string, whole string, done boolean"
_NODE = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("whole", pa.string()), ("done", pa.bool_())])


def _up(first: bool, step: int) -> Callable:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for g, block, nodes in _blocks(batches):
                digests = [n["digest"] for n in nodes]
                if block == 0 and len(nodes) == 1 and not first:  # the group's only node: its tree has ended
                    yield g, 0, nodes[0]["whole"], None, True
                    continue
                whole = digests[0] if len(digests) == 1 else None
                for level in _climb(digests, step):
                    digests = level
                    if whole is None and len(level) == 1:
                        whole = level[0]
                yield g, block, digests[0], whole if block == 0 else None, False

        return _batches(rows(), _NODE)

    return fold


@dataclass
class Tree:
    """Stored levels of one tree for each group; the last levels hold the groups' roots, marked ``done``."""

    levels: list[DataFrame]
    step: int

    def roots(self) -> list[tuple[int, DataFrame]]:
        """(stored level of the group's only node, rows of g and root)."""
        return [(i - 1, t.filter("done").select("g", F.col("digest").alias("root"))) for i, t in enumerate(self.levels) if i > 1]


def build(leaves: DataFrame, scratch: Scratch, step: int = STEP) -> Tree:
    """The tree over rows of (g, pos, digest) with places from 0 in each group; one round for each stored level."""
    levels = [leaves]
    while True:
        first = len(levels) == 1
        below = levels[-1] if first else levels[-1].filter("not done")
        nodes = below.select("g", F.shiftright("pos", step).alias("block"), "pos", "digest", *["whole"] * (not first))
        dealt = nodes.repartition("g", "block").sortWithinPartitions("g", "block", "pos")
        levels.append(scratch.put(dealt.mapInArrow(_up(first, step), NODE), "level"))
        if levels[-1].filter("not done").isEmpty():
            return Tree(levels, step)


PATH = "g string, pos bigint, alone boolean, path array<string>, subroot string"
_PATH = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("alone", pa.bool_()), ("path", pa.list_(pa.string())), ("subroot", pa.string())])


def _proofs(nodes: list[dict], alone: bool, step: int) -> Iterator[list[str]]:
    """For each node of a subtree its siblings up to the subtree's root: L or R and a digest, or nothing where a run has one node."""
    digests = [n["digest"] for n in nodes]
    interior = [digests, *_climb(digests, _height(len(digests)) if alone else step)]
    for i in range(len(digests)):
        path = []
        for level in interior[:-1]:
            other = i ^ 1
            path.append("" if other >= len(level) else ("L" if other < i else "R") + level[other])
            i >>= 1
        yield path


def _down(step: int) -> Callable:
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for g, _, (top, *nodes) in _blocks(batches):
                for n, path in zip(nodes, _proofs(nodes, top["alone"], step)):
                    yield g, n["pos"], False, path + top["path"], top["subroot"]

        return _batches(rows(), _PATH)

    return extend


def _dealt(nodes: DataFrame, paths: DataFrame, step: int, *extra: str) -> DataFrame:
    """Nodes of each subtree after its root's path, subtrees dealt over the tasks."""
    below = nodes.select("g", F.shiftright("pos", step).alias("block"), "pos", "digest", *extra)
    above = paths.select("g", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "alone", "path", "subroot")
    return below.unionByName(above, allowMissingColumns=True).repartition("g", "block").sortWithinPartitions("g", "block", "pos")


def paths(tree: Tree, starts: DataFrame, scratch: Scratch) -> DataFrame:
    """Paths of the nodes of the first stored level above the leaves; ``starts`` has (g, path, subroot) of each group's root."""
    found = starts.limit(0).select("g", F.lit(0).cast("long").alias("pos"), F.lit(True).alias("alone"), "path", "subroot")
    for i, roots in reversed(tree.roots()):
        here = roots.join(starts, "g").select("g", F.lit(0).cast("long").alias("pos"), F.lit(True).alias("alone"), "path", "subroot")
        found = here.unionByName(found)
        if i > 1:
            found = scratch.put(_dealt(tree.levels[i - 1].filter("not done"), found, tree.step).mapInArrow(_down(tree.step), PATH), "paths")
    return found


def _leaf_proofs(schema: pa.Schema, step: int) -> Callable:
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for _, _, (top, *nodes) in _blocks(batches):
                above = "".join(p[1:] for p in top["path"])
                tops: dict[str, str] = {}
                for n, path in zip(nodes, _proofs(nodes, top["alone"], step)):
                    at = folded(n["now"], path)
                    if at not in tops:  # whole leaves meet in the subtree's root
                        tops[at] = folded(at, top["path"])
                    proof = H(*(p[1:] for p in path), above)
                    row = n["key"], n["digest"], top["subroot"], proof, tops[at]
                    yield (*row, path + top["path"]) if len(schema) > len(row) else row

        return _batches(rows(), schema)

    return fold


def _names(step: int) -> Callable:
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(group, path, root) of the leaves of the tree over groups."""

        def rows():
            for _, _, (top, *nodes) in _blocks(batches):
                for n, path in zip(nodes, _proofs(nodes, top["alone"], step)):
                    yield n["name"], path + top["path"], n["digest"]

        return _batches(rows(), pa.schema([("g", pa.string()), ("path", pa.list_(pa.string())), ("subroot", pa.string())]))

    return extend


def folded(digest: str, path: list[str]) -> str:
    """The root that a digest and its siblings lead to."""
    for p in path:
        digest = H(digest) if not p else H(p[1:], digest) if p[0] == "L" else H(digest, p[1:])
    return digest


def manifest(df: DataFrame, key: str, group: str, leaf_digest: Column, now: Column | None = None, siblings: bool = False, step: int = STEP) -> DataFrame:
    """Rows of (key, leaf, subroot, root, proof_sha256, folded_root, siblings) for each row of ``df``.

    ``now`` is the leaf's digest at the time of verification (the leaf's own if
    not given): ``folded_root`` is what it leads to by the stored siblings.
    ``siblings``, from the leaf to the root, begin with L or R for their side and
    are empty where a run has one node; they are given where asked for.  Every
    ``step``-th level is stored.
    """
    scratch = Scratch(df.sparkSession, "merkle")
    g = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    own = df.select(F.col(key).alias("key"), g.alias("g"), leaf_digest.alias("digest"), (leaf_digest if now is None else now).alias("now"))
    leaves = scratch.put(numbered(own, scratch, "g", ["key", "digest"]), "leaves")
    tree = build(leaves, scratch, step)
    roots = [t for _, t in tree.roots()] or [leaves.limit(0).select("g", F.col("digest").alias("root"))]
    groups = reduce(DataFrame.unionByName, roots).select(F.lit("").alias("all"), F.col("g").alias("name"), "root")
    groups = numbered(groups, scratch, "all", ["name"]).select(F.col("all").alias("g"), "pos", F.col("root").alias("digest"), "name")
    tops = build(scratch.put(groups, "groups"), scratch, step)
    root = next((r.root for _, t in tops.roots() for r in t.collect()), None)  # one row: the root of all
    start = df.sparkSession.createDataFrame([("", [], None)], "g string, path array<string>, subroot string")
    starts = scratch.put(_dealt(tops.levels[0], paths(tops, start, scratch), step, "name").mapInArrow(_names(step), "g string, path array<string>, subroot string"), "starts")
    columns = [("key", df.schema[key].dataType), *((c, StringType()) for c in ("leaf", "subroot", "proof_sha256", "folded_root"))]
    columns += [("siblings", ArrayType(StringType()))] * siblings
    schema = StructType([StructField(*c) for c in columns])
    proofs = _leaf_proofs(pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema]), step)
    found = _dealt(leaves, paths(tree, starts, scratch), step, "key", "now").mapInArrow(proofs, schema)
    result = ["leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root", *["siblings"] * siblings]
    return found.select(F.col("key").alias(key), *result)


def op12_merkle_manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of each document, and whether it still leads to the root after some have been tampered with."""
    fields = {c: F.col(c) for c in FIELDS}
    more = leaf(*(fields | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}).values())
    tampered = F.col("doc_id").isNotNull() & (crc_mod("doc_id", 7) == 0)
    found = manifest(docs, "doc_id", "lang", leaf(*fields.values()), F.when(tampered, more).otherwise(leaf(*fields.values())))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
