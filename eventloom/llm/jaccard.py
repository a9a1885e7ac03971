"""Exact n-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are documents, columns are hashes of word
n-grams.  Two documents link when their sets' Jaccard similarity is at least
``threshold``.  What bounds the product, without losing a link:

* Documents with the same set are one row; copies never meet each other.
* Columns have one global order, frequent ones last (a hint from each task's
  own counts; any order is right).  A link needs a common column among the
  first n - ceil(t n) + 1 of both rows, so only those enter the product.
* Columns are dealt to blocks by their hash.  In columns of fewer than SMALL
  rows a block counts all pairs of rows.  In larger ones rows are first paired
  only with central rows of their column; each row's best such pair is verified
  and components form, which is where large groups of near copies end.  Columns
  whose hint is over HOT rows never meet in one task: their central rows, one for
  each class of sizes, come from an aggregation, and rows join them by salted keys.
* Then the incidence of the rows of different components is multiplied in the
  larger columns: the rows of a column's largest component and the others are
  cut into blocks of about SIDE, and each pair of blocks is a cell group of its
  own, where each pair's count over its whole prefixes is made.
* A pair is dropped when sizes rule it out, or when its count plus what can
  follow the shorter prefix is less than the overlap needed.
* Pairs left are verified on whole sets.

A document's links all lie in its component.  They are counted there on whole
sets, in blocks of about BLOCK sets against each other; a task holds one pair of
blocks and gives counts, never pairs, and a set counts once for each of its copies.

Edge cases: words are split at ASCII white space after A-Z are lowered; fewer
than n words are one n-gram; null or blank texts have the empty set, link to
nothing and are their own component.  Rows repeated with the same id are one
document; a null id is a document of its own without links.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import Scratch, at_most, fresh, word_bytes
from .graph import components

N_WORDS = 5
THRESHOLD = Fraction(4, 5)
#: Columns with a hint of frequency that are kept, the most frequent; the rest count as rare.
HINTS = 1_000_000
#: n-grams in one local count, and the local count from which a column is reported.
LOCAL, REPORT = 4_000_000, 2
#: Rows of a column from which pairs are formed by central rows first; log2 of the hint above which a column is hot.
SMALL, HOT = 16, 8
#: Parts into which the rows of a hot column are dealt to meet their central row.
SALTS = 32
#: Rows on one side of a block pair in which different components are multiplied.
SIDE = 256
#: Sets of a component in one block when links are counted, and sets in one product.
BLOCK, TILE = 256, 256
BASE = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 65_536:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def shingle_set(text: str | None, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""
    words = word_bytes(text)
    if not words:
        return np.zeros(0, dtype=np.int64)
    v = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(n, len(v))
    h = np.full(len(v) - k + 1, np.uint64(k))
    for i in range(k):
        h = h * BASE + v[i : len(v) - k + 1 + i]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return np.unique(h.view(np.int64))


def overlap_needed(a: int, b: int, t: Fraction) -> int:
    """The least common size that makes two sets of these sizes similar."""
    return -(-t.numerator * (a + b) // (t.numerator + t.denominator))


def _frequent(docs: DataFrame, n: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and log2 counts of columns that are frequent in some task's part."""

    def count(batches):
        held, size = [], 0

        def report():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            keep = c >= REPORT
            return pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(c[keep].astype(np.int64))], names=["h", "c"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(shingle_set(t, n))
                size += len(held[-1])
                if size >= LOCAL:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()

    top = docs.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    top = at_most(scratch.put(top, "hints"), "c", HINTS).toPandas()
    order = np.argsort(top.h.to_numpy(dtype=np.int64))
    return top.h.to_numpy(dtype=np.int64)[order], np.log2(top.c.to_numpy(dtype=np.float64)[order]).astype(np.int32)


def _rows(docs: DataFrame, n: int, t: Fraction, scratch: Scratch) -> DataFrame:
    """(id, n, set_key, prefix, ranks, last_rank, last, usual): each document's size, ordered prefix, and how frequent that is."""
    hints = docs.sparkSession.sparkContext.broadcast(_frequent(docs, n, scratch))
    schema = "id long, n int, set_key binary, prefix array<long>, ranks array<byte>, last_rank int, last long, usual int"
    arrow = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("set_key", pa.binary()), ("prefix", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int8())), ("last_rank", pa.int32()), ("last", pa.int64()), ("usual", pa.int32())])

    def make(batches):
        known, rank = hints.value
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shingle_set(text, n)
                if not len(s):
                    out.append((key, 0, b"", [], [], 0, 0, 0))
                    continue
                r = np.zeros(len(s), dtype=np.int32)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    r = np.where(known[at] == s, rank[at], 0)
                p = len(s) - -(-t.numerator * len(s) // t.denominator) + 1
                first = np.argsort(r, kind="stable")[:p]
                out.append((key, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), s[first], r[first].astype(np.int8), int(r[first[-1]]), int(s[first[-1]]), int(r[first].mean() * 1000)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)] if out else [pa.array([], f.type) for f in arrow], schema=arrow)

    return docs.mapInArrow(make, schema)


def _cells(rows: DataFrame) -> DataFrame:
    """(h, hot, n, id, usual): the incidence matrix's prefix part."""
    cells = rows.select(F.explode(F.arrays_zip("prefix", "ranks")).alias("x"), "n", "id", "usual")
    return cells.select(F.col("x.prefix").alias("h"), (F.col("x.ranks") > HOT).alias("hot"), "n", "id", "usual")


def _columns(rows: DataFrame) -> DataFrame:
    """(h, n, id, usual): the columns that aren't hot, dealt by column to blocks and sorted by it."""
    return _cells(rows).filter("NOT hot").drop("hot").repartition("h").sortWithinPartitions("h", "id")


def _hot_stars(rows: DataFrame, t: Fraction) -> DataFrame:
    """(a, b, c): in how many hot columns row a is the central one of row b and of like size.

    Central is the row whose prefix is most usual; sizes of one class are always comparable.
    """
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(t.denominator / t.numerator))
    cells = _cells(rows).filter("hot").select("h", size.alias("size"), "id", "usual")
    central = cells.groupBy("h", "size").agg(F.max_by("id", F.struct("usual", (-F.col("id")).alias("id"))).alias("a"))
    central = central.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = cells.select("h", "size", F.col("id").alias("b"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    return dealt.join(central, ["h", "size", "salt"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))


def _runs(batches, width: int):
    """Cells of sorted batches as lists of arrays that hold whole columns, with the bounds of these."""
    rest = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
        now = now if rest is None else [np.concatenate(x) for x in zip(rest, now)]
        if not len(now[0]):
            continue
        cut = np.flatnonzero(np.append(True, now[0][1:] != now[0][:-1]))
        rest = [x[cut[-1] :] for x in now]
        if len(cut) > 1:
            yield [x[: cut[-1]] for x in now], cut
    if rest is not None:
        yield rest, np.array([0, len(rest[0])])


def _comparable(a, b, t: Fraction):
    return np.minimum(a, b) * t.denominator >= np.maximum(a, b) * t.numerator


def _all_pairs(cells, cut, t: Fraction):
    """Pairs of rows (smaller id first) in columns of fewer than SMALL rows."""
    n, doc = cells[1], cells[2]
    lengths = np.diff(cut)
    for k in range(2, SMALL):
        first = cut[:-1][lengths == k]
        if len(first):
            x, y = np.triu_indices(k, 1)
            x, y = (first[:, None] + x).ravel(), (first[:, None] + y).ravel()
            ok = _comparable(n[x], n[y], t)
            yield doc[x[ok]], doc[y[ok]]


def _central_pairs(cells, cut, t: Fraction):
    """Pairs of a central row and another in columns of SMALL rows or more.

    Central are the rows whose prefix is most usual, so the source of copies
    rather than one of them; rows that sizes keep from one have a next.  A row
    without a partner is paired with itself, so that it is known to be here.
    """
    n, doc, usual = cells[1:4]
    for i in np.flatnonzero(np.diff(cut) >= SMALL).tolist():
        left = np.arange(cut[i], cut[i + 1])
        left = left[np.lexsort((doc[left], -usual[left]))]
        while len(left):
            ok = _comparable(n[left[0]], n[left], t)
            to = left[ok][1:] if ok.sum() > 1 else left[:1]
            yield np.full(len(to), doc[left[0]]), doc[to]
            left = left[~ok]


def _incidence(prefixes: list[np.ndarray]) -> np.ndarray:
    """Rows by columns of some prefixes as 0 and 1; columns that only one of them has are left out."""
    sizes = np.array([len(x) for x in prefixes])
    _, code, count = np.unique(np.concatenate(prefixes), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(prefixes)), sizes)
    keep = count[code] > 1
    new = np.cumsum(count > 1) - 1
    out = np.zeros((len(prefixes), int((count > 1).sum())), dtype=np.float32)
    out[row[keep], new[code[keep]]] = 1
    return out


def _crossing_pairs(cells, cut, t: Fraction):
    """Pairs of rows of different components in the block pairs of ``_blocks`` that may be similar.

    The product of the rows' incidence matrices gives the whole count of common
    prefix columns of each pair, so that the size-derived bound is applied here
    and pairs that fail it never leave the block.
    """
    second, doc, comp, n, last_rank, last, prefix, within = cells[1:9]
    num, den = t.numerator, t.numerator + t.denominator
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        at = np.arange(lo, hi)
        left_side, right_side = at[second[lo:hi] == 0], at[second[lo:hi] == 1]
        alone = bool(within[lo])
        if alone:
            right_side = left_side
        for i in range(0, len(left_side), TILE):
            left = left_side[i : i + TILE]
            for k in range(0, len(right_side), TILE):
                r = right_side[k : k + TILE]
                both = _incidence([prefix[x] for x in (*left, *r)])
                common = (both[: len(left)] @ both[len(left) :].T).astype(np.int64)
                a, p = left[:, None], np.array([len(prefix[x]) for x in left])[:, None]
                q = np.array([len(prefix[x]) for x in r])
                first = (last_rank[a] < last_rank[r]) | ((last_rank[a] == last_rank[r]) & (last[a] <= last[r]))
                most_common = common + np.where(first, n[a] - p, n[r] - q)
                ok = (comp[a] != comp[r]) & _comparable(n[a], n[r], t) & (most_common * den >= num * (n[a].astype(np.int64) + n[r]))
                if alone:  # a block with itself
                    ok &= a < r
                x, y = np.nonzero(ok)
                if len(x):
                    x, y = doc[left[x]], doc[r[y]]
                    yield np.minimum(x, y), np.maximum(x, y)


def _blocks(inner: DataFrame, scratch: Scratch) -> DataFrame:
    """Cells of block pairs: the rows of large or hot columns with several components, by pairs of blocks of about SIDE rows.

    A column's largest component stands on one side only: its rows meet all
    others, never each other.
    """
    cells = inner.select(F.explode(F.arrays_zip("prefix", "ranks")).alias("x"), "id", "comp")
    cells = scratch.put(cells.select(F.col("x.prefix").alias("h"), (F.col("x.ranks") > HOT).alias("hot"), "id", "comp"), "cells")
    by = cells.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("k"), F.max("hot").alias("hot"))
    mixed = by.groupBy("h").agg(F.sum("k").alias("n"), F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("kinds"), F.max("hot").alias("hot"))
    mixed = mixed.filter(((F.col("n") >= SMALL) | F.col("hot")) & (F.col("kinds") > 1))
    blocks = lambda n: F.ceil(n / SIDE).cast("int")
    mixed = scratch.put(mixed.select("h", F.col("m.comp").alias("most"), blocks(F.col("m.k")).alias("mains"), blocks(F.col("n") - F.col("m.k")).alias("outs")), "mixed")
    own = cells.join(mixed, "h")
    main = F.col("comp") == F.col("most")
    block = F.pmod(F.xxhash64("id"), F.when(main, F.col("mains")).otherwise(F.col("outs")))
    at = lambda kind, x, y, second: F.struct(F.lit(kind).alias("kind"), x.cast("long").alias("x"), y.cast("long").alias("y"), second.cast("int").alias("second"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    of_main = F.transform(upto(F.col("outs")), lambda j: at(0, block, j, F.lit(1)))
    of_out = F.concat(F.transform(upto(F.col("mains")), lambda i: at(0, i, block, F.lit(0))), F.transform(upto(F.col("outs")), lambda j: at(1, F.least(block, j), F.greatest(block, j), block > j)))
    keyed = own.select("h", "id", F.explode(F.when(main, of_main).otherwise(of_out)).alias("p"))
    keyed = keyed.select(F.xxhash64("h", "p.kind", "p.x", "p.y").alias("h"), F.col("p.second").alias("second"), "id", ((F.col("p.kind") == 1) & (F.col("p.x") == F.col("p.y"))).alias("within"))
    return keyed.join(inner.select("id", "comp", "n", "last_rank", "last", "prefix"), "id").select("h", "second", "id", "comp", "n", "last_rank", "last", "prefix", "within")


def _summed(kind: int, pairs: list):
    a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    counts = np.diff(np.append(new, len(a)))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(new), kind, dtype=np.int32)), pa.array(a[new]), pa.array(b[new]), pa.array(counts)], names=["kind", "a", "b", "c"])


def _product(cells: DataFrame, width: int, steps: dict, t: Fraction) -> DataFrame:
    """(kind, a, b, c): overlap counts over cells sorted by their group, by the kinds of pairs in ``steps``."""

    def multiply(batches):
        held, size = {kind: [] for kind in steps}, dict.fromkeys(steps, 0)
        for cells, cut in _runs(batches, width):
            for kind, step in steps.items():
                for pair in step(cells, cut, t):
                    if len(pair[0]):
                        held[kind].append(pair)
                        size[kind] += len(pair[0])
                        if size[kind] > 500_000:
                            yield _summed(kind, held[kind])
                            held[kind], size[kind] = [], 0
        for kind, pairs in held.items():
            if pairs:
                yield _summed(kind, pairs)

    got = cells.mapInArrow(multiply, "kind int, a long, b long, c long")
    return got.groupBy("kind", "a", "b").agg(F.sum("c").alias("c"))


def _whole_sets(docs: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """(id, s): the sets of the documents in some pairs."""

    def whole(batches):
        for batch in batches:
            s = [shingle_set(x, n) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.list_(pa.int64()))], names=["id", "s"])

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return docs.join(ids, "id", "left_semi").select("id", "text").mapInArrow(whole, "id long, s array<long>")


def _one_set_each(docs: DataFrame, pairs: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """(id, s): one set for each document in some pairs."""
    sets = scratch.put(_whole_sets(docs, pairs, n), "sets")
    if not sets.groupBy("id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").isEmpty():
        sets = scratch.put(sets.dropDuplicates(["id"]), "sets")  # rows repeated with one id: one of them counts
    return sets


def _verified(pairs: DataFrame, docs: DataFrame, n: int, t: Fraction, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar."""
    sets = _one_set_each(docs, pairs, n, scratch)
    left, right = (sets.select(F.col("id").alias(k), F.col("s").alias(f"s{k}")) for k in ("a", "b"))

    @F.arrow_udf("boolean")
    def similar(x: pa.Array, y: pa.Array) -> pa.Array:
        vx, vy = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
        ox, oy = x.offsets.to_numpy(), y.offsets.to_numpy()
        out = []
        for i in range(len(x)):
            a, b = vx[ox[i] : ox[i + 1]], vy[oy[i] : oy[i + 1]]
            both = np.concatenate([a, b])
            both.sort()
            out.append(int((both[1:] == both[:-1]).sum()) >= overlap_needed(len(a), len(b), t))
        return pa.array(out, pa.bool_())

    return pairs.select("a", "b").join(right, "b").join(left, "a").filter(similar("sa", "sb")).select("a", "b")


def _tile_links(cells, cut, t: Fraction):
    """(row, links) of the cells of block pairs: how many documents of the other block each row's set is similar to."""
    second, weight, comp, sets = cells[1], cells[3], cells[4], cells[5]
    size = np.array([len(x) for x in sets], dtype=np.int64)
    num, den = t.numerator, t.numerator + t.denominator
    links = np.zeros(len(size), dtype=np.int64)
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
        at = np.arange(lo, hi)
        a, b = at[second[lo:hi] == 0], at[second[lo:hi] == 1]
        alone = not len(b)  # a block with itself
        b = a if alone else b
        for i in range(0, len(a), TILE):
            for j in range(i if alone else 0, len(b), TILE):
                x, y = a[i : i + TILE], b[j : j + TILE]
                same = alone and i == j
                both = _incidence([sets[k] for k in (x if same else (*x, *y))])
                common = (both[: len(x)] @ both[0 if same else len(x) :].T).astype(np.int64)
                ok = (comp[x][:, None] == comp[y]) & (common * den >= num * (size[x][:, None] + size[y]))
                if same:  # both halves of the square, without the diagonal
                    np.fill_diagonal(ok, False)
                    links[x] += ok @ weight[y]
                else:
                    links[x] += ok @ weight[y]
                    links[y] += weight[x] @ ok
    return links


def _links(comp: DataFrame, copies: DataFrame, docs: DataFrame, n: int, t: Fraction, scratch: Scratch) -> DataFrame:
    """(v, links): how many documents with another set each set (by its smallest id) of a component is similar to."""
    sets = _one_set_each(docs, comp.select(F.col("v").alias("a"), F.col("v").alias("b")), n, scratch)
    sizes = comp.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    members = scratch.put(comp.join(sizes, "c").join(copies.select(F.col("id").alias("v"), "copies"), "v"), "members")
    own = F.pmod(F.xxhash64("v"), F.col("blocks"))
    # a row of block i is on the first side of (i, j) for j >= i, on the second of (j, i) for j < i
    other = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keyed = other.select(F.xxhash64("c", F.least("own", "other"), F.greatest("own", "other")).alias("h"), (F.col("own") > F.col("other")).cast("int").alias("second"), "v", "copies", "c", (F.col("own") == F.col("other")).alias("within"))
    # a pair of blocks of which one is empty has nothing to count
    sides = keyed.groupBy("h").agg((F.max("within") | (F.min("second") < F.max("second"))).alias("whole")).filter("whole").select("h")
    cells = keyed.join(sides, "h").join(sets, F.col("v") == F.col("id")).select("h", "second", "v", "copies", "c", "s")

    def count(batches):
        for cells, cut in _runs(batches, 6):
            links = _tile_links(cells, cut, t)
            yield pa.RecordBatch.from_arrays([pa.array(cells[2], pa.int64()), pa.array(links, pa.int64())], names=["v", "links"])

    got = cells.repartition("h").sortWithinPartitions("h").mapInArrow(count, "v long, links long")
    return got.groupBy("v").agg(F.sum("links").alias("links"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N_WORDS, threshold: Fraction = THRESHOLD, links: bool = True) -> DataFrame:
    """(id, n_shingles, component_id, n_links) of each row of ``docs``.

    ``n_links`` is the number of other documents whose similarity to this one
    is at least ``threshold``; without ``links`` it is null and costs nothing.
    """
    t, scratch = Fraction(threshold), Scratch(docs.sparkSession, "jaccard")
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    if isinstance(docs.schema["id"].dataType, IntegralType):
        out = _components(docs.withColumn("id", F.col("id").cast("long")), n, t, links, scratch)
        kind = docs.schema["id"].dataType
        return out.withColumns({c: F.col(c).cast(kind) for c in ("id", "component_id")})
    # other keys are numbered in their order
    keys = docs.select("id").filter("id IS NOT NULL").distinct().repartitionByRange("id").sortWithinPartitions("id").withColumn("n", F.monotonically_increasing_id())
    keys = scratch.put(keys, "keys")
    numbered = scratch.put(docs.join(keys, "id", "left").select(F.col("n").alias("id"), "text"), "numbered")
    out = _components(numbered, n, t, links, scratch, (keys, numbered))
    own, least = (keys.select(F.col("n").alias(a), F.col("id").alias(b)) for a, b in (("id", "_own"), ("component_id", "_least")))
    out = out.join(own, "id", "left").join(least, "component_id", "left")
    return out.select(F.col("_own").alias("id"), "n_shingles", F.col("_least").alias("component_id"), "n_links")


def _components(docs: DataFrame, n: int, t: Fraction, links: bool, scratch: Scratch, kept: tuple[DataFrame, ...] = ()) -> DataFrame:
    """The rows of ``jaccard_components`` for whole numbers as ids."""
    rows = scratch.put(_rows(docs, n, t, scratch), "rows")
    full = rows.filter("n > 0 AND id IS NOT NULL")
    # one row for each set: its smallest id stands for it
    firsts = [F.first(c).alias(c) for c in ("n", "prefix", "ranks", "last_rank", "last", "usual")]
    distinct = full.groupBy("set_key", "id").agg(*firsts)
    reps = scratch.put(distinct.groupBy("set_key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), *firsts), "reps")
    every, central, crossing = 0, 1, 2
    first = scratch.put(_product(_columns(reps), 4, {every: _all_pairs, central: _central_pairs}, t), "first")
    stars = first.filter(F.col("kind") == central).select("a", "b", "c").unionByName(scratch.put(_hot_stars(reps, t), "hot"))
    in_large = scratch.put(stars.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "in_large")
    best = stars.filter("a <> b").groupBy("b").agg(F.max(F.struct("c", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b")
    found = scratch.put(_verified(scratch.put(best, "best"), docs, n, t, scratch), "found")
    comp = components(found, scratch)
    inner = reps.join(in_large, "id", "left_semi").join(comp.select(F.col("v").alias("id"), F.col("c").alias("comp")), "id", "left")
    inner = scratch.put(inner.withColumn("comp", F.coalesce("comp", "id")), "inner")
    blocks = _blocks(inner, scratch)
    rest = _product(blocks.repartition("h").sortWithinPartitions("h", "id"), 9, {crossing: _crossing_pairs}, t)
    pairs = first.filter(F.col("kind") == every)
    size = reps.select("id", "n", "last_rank", "last", F.size("prefix").alias("p"))
    sa, sb = (size.select(*[F.col(c).alias(c + k) for c in size.columns]) for k in ("a", "b"))
    pairs = pairs.join(sa, pairs.a == sa.ida).join(sb, pairs.b == sb.idb)
    ends_first = (F.col("last_ranka") < F.col("last_rankb")) | ((F.col("last_ranka") == F.col("last_rankb")) & (F.col("lasta") <= F.col("lastb")))
    beyond = F.when(ends_first, F.col("na") - F.col("pa")).otherwise(F.col("nb") - F.col("pb"))
    enough = (F.col("c") + beyond) * (t.numerator + t.denominator) >= t.numerator * (F.col("na") + F.col("nb"))
    # a pair of `every` that also shares a larger column is among `rest`, by its whole count, or in one component
    pairs = scratch.put(pairs.filter(enough).select("a", "b").unionByName(rest.select("a", "b")).distinct(), "pairs")
    more = scratch.put(_verified(pairs, docs, n, t, scratch), "more")
    if not more.isEmpty():
        comp = components(found.unionByName(more), scratch)
    of_set = reps.select("set_key", F.col("id").alias("v"), "copies").join(comp, "v", "left").withColumn("c", F.coalesce("c", "v"))
    scratch.keep(rows, reps, comp, *kept)
    if links:
        counted = scratch.put(_links(comp, reps, docs, n, t, scratch), "links")
        of_set = of_set.join(counted, "v", "left")
        scratch.keep(rows, reps, comp, counted, *kept)
    else:
        of_set = of_set.withColumn("links", F.lit(None).cast("long"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    of_set = of_set.select("set_key", "c", (n_links if links else F.col("links")).alias("n_links"))
    out = rows.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("set_key")).alias("set_key")).join(of_set, "set_key", "left")
    n_links = F.coalesce("n_links", F.lit(0).cast("long")) if links else F.col("n_links")
    return out.select("id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("c", "id").alias("component_id"), n_links.alias("n_links"))


def op5_ngram_jaccard(docs: DataFrame) -> DataFrame:
    """Set size, component and number of links of every document."""
    return jaccard_components(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "n_links")


def keep_one(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of each component's smallest id; rows repeated with one id stay or go together; null ids stay."""
    found = jaccard_components(docs, key, links=False).filter("id IS NOT NULL AND id <> component_id").select("id").distinct()
    name = fresh(docs, "id")
    return docs.join(found.withColumnRenamed("id", name), docs[key] == F.col(name), "left_anti").select(*docs.columns)
