"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A fingerprint has bit j set if most words of a window have bit j set in their
hash.  A span that is similar enough lacks at most a fifth of an item's shingles
(where the text ends; a ninth elsewhere), so an item's windows are shorter by that much (and by ``step`` -
1 words): one at every word of the item, so that one of them lies whole in any
such span.  Windows of a text start at every ``step``-th word, which is 1 for
short items.  Copies that are cut at the borders, or edited within SHINGLE - 1
words of one, so have a window in common with the item, word by word; items of
fewer than about 50 words have no other copies over the threshold.  Edits in the
middle of longer ones flip a few bits of the windows over them.

Fingerprints are cut into BLOCKS of bits.  Two that differ in at most RADIUS
bits differ in at most one bit of some block (pigeonhole), so a lookup of every
block's value among the values of the items, each with every one of its bits
flipped, finds all within the radius.  The spans around a hit are then compared
by weighted Jaccard of word shingles, each with its count as weight; the best
one decides.  The README tells the recall on near copies.

Items are broadcast in groups of a checked size; more items mean more passes
over the texts, never fewer comparisons.

Edge cases: words are runs of bytes other than ASCII white space and
punctuation, lowered; items without words match nothing; items with fewer
than five words are one shingle; null and empty texts match nothing; a text is
searched whole; equal texts give equal results; items repeated are one, with
different texts each its own; ties between spans go to the earliest; a span has
the item's length, or what is left of it where the text begins or ends in it;
further columns of both tables don't matter; empty tables give no matches.
"""

from __future__ import annotations

from collections import Counter, OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, StructField, StructType

from .common import fresh

BITS, BLOCKS = 64, 4
RADIUS = 2 * BLOCKS - 1
SHINGLE = 5
THRESHOLD = 0.8
#: Words in one vectorised pass; items, and characters of items, in one broadcast.
WORDS, ITEMS, ITEM_CHARS = 1 << 16, 20_000, 4 << 20
#: Bytes of indexes that a worker keeps.
KEPT = 256 << 20
_PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum())
_LOWER = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
#: What flips none or one bit of a block.
FLIPS = np.array([0, *(1 << i for i in range(BITS // BLOCKS))], dtype=np.int64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 65_536:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, seed=1)
        return h


_hashes = _Hashes()


def words(text: str | None) -> np.ndarray:
    """Hashes of a text's words in order."""
    found = text.lower().encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    return np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))


def shingles(v: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` words; of all words where there are fewer."""
    k = min(size, len(v))
    h = np.full(len(v) - k + 1 if k else 0, np.uint64(k))
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + v[i : len(v) - k + 1 + i]
    return h


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of the shingles of two runs of words."""
    x, y = Counter(shingles(a).tolist()), Counter(shingles(b).tolist())
    both = sum((x & y).values())
    total = sum(x.values()) + sum(y.values()) - both
    return both / total if total else 0.0


def slack(n: int, threshold: float = THRESHOLD) -> int:
    """How many words a similar enough span may lack at the borders of an item of n words."""
    m = max(1, n - SHINGLE + 1)
    return int(m * (1 - threshold) + 1e-9)


def window(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(step, width) of the windows for an item of n words: width + step - 1 + slack <= n."""
    step = 1
    while n >= 24 * step:
        step *= 2
    width = max(1, n - slack(n, threshold) - step + 1)
    grain = 1 << max(0, width.bit_length() - 3)  # four widths between powers of two
    return step, width // grain * grain


def best_span(doc: np.ndarray, v: np.ndarray, starts: list[tuple[int, int]]) -> tuple[float, int]:
    """(similarity, start) of the best span of an item's length among ranges of starts; a negative start is cut to 0."""
    n, k = len(v), min(SHINGLE, len(v))
    wanted = Counter(shingles(v).tolist())
    m, best = n - k + 1, (0.0, 0)
    for first, last in starts:
        base = max(0, first)
        h = shingles(doc[base : last + n], k).tolist() if min(len(doc), last + n) - base >= k else []
        have, both, lo, hi = Counter(), 0, base, base  # shingles that start in lo..hi - 1 are counted
        for s in range(first, last + 1):
            start, stop = max(0, s), min(s + n, len(doc)) - k + 1
            while hi < stop:
                x = h[hi - base]
                if x in wanted:
                    have[x] += 1
                    both += have[x] <= wanted[x]
                hi += 1
            while lo < min(start, hi):
                x = h[lo - base]
                if x in wanted:
                    both -= have[x] <= wanted[x]
                    have[x] -= 1
                lo += 1
            found = (both / (m + max(0, stop - start) - both), start)
            if (-found[0], found[1]) < (-best[0], best[1]):
                best = found
    return best


def _bits(v: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(v).view(np.uint8)).reshape(-1, BITS)


def _sums(v: np.ndarray, wide: bool) -> np.ndarray:
    """Running counts of each bit; a difference over a window is right modulo the type's range."""
    out = np.zeros((len(v) + 1, BITS), dtype=np.uint32 if wide else np.uint8)
    np.cumsum(_bits(v), axis=0, out=out[1:])
    return out


def prints(sums: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Fingerprints of the windows that start at every ``step``-th word."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    ones = sums[width::step] - sums[:n:step]
    return np.packbits(ones > width // 2).view(np.uint64)


class Index:
    """Fingerprints of items by window size, with a lookup for each block of bits."""

    def __init__(self, items: list[tuple[object, str]], threshold: float = THRESHOLD):
        self.items = [(key, v) for key, text in items if len(v := words(text))]
        self.threshold = threshold
        by: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for place, (_, v) in enumerate(self.items):
            step, width = window(len(v), threshold)
            by.setdefault((step, width), []).append((place, prints(_sums(v, width > 255), width)))
        #: By step and width: fingerprints, the item and the offset of each, and the lookups.
        self.classes = {}
        size = 64 // BLOCKS
        for kind, rows in by.items():
            every = np.concatenate([r[1] for r in rows])
            places = np.repeat([r[0] for r in rows], [len(r[1]) for r in rows])
            offsets = np.concatenate([np.arange(len(r[1])) for r in rows])
            lookups = []
            for block in range(BLOCKS):
                value = every.view(np.uint16).reshape(-1, BLOCKS)[:, block].astype(np.int64)
                near = (value[:, None] ^ FLIPS).ravel()
                order = np.argsort(near, kind="stable").astype(np.int32)
                bounds = np.searchsorted(near[order], np.arange((1 << size) + 1)).astype(np.int32)
                lookups.append((order // np.int32(len(FLIPS)), bounds))
            self.classes[kind] = (every, places, offsets, lookups)
        self.bytes = sum(x.nbytes for c in self.classes.values() for pair in c[3] for x in pair)

    def near(self, found: np.ndarray, kind: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item fingerprint) within RADIUS bits."""
        every, _, _, lookups = self.classes[kind]
        values, got = found.view(np.uint16).reshape(-1, BLOCKS), []
        for block, (of, bounds) in enumerate(lookups):
            value = values[:, block]
            first = bounds[value]
            n = bounds[value.astype(np.int32) + 1] - first
            some = np.flatnonzero(n)
            n = n[some]
            at = np.repeat(some, n)
            to = of[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[some], n)]
            close = np.bitwise_count(found[at] ^ every[to]) <= RADIUS
            got.append(at[close] * len(every) + to[close])
        both = np.unique(np.concatenate(got))
        return both // len(every), both % len(every)

    def search(self, docs: list[np.ndarray], threshold: float | None = None) -> list[list[dict]]:
        """The matches of each document: the best span of each item that is similar enough."""
        threshold = self.threshold if threshold is None else threshold
        sizes = np.array([len(v) for v in docs], dtype=np.int64)
        ends = np.cumsum(sizes)
        flat = np.concatenate(docs) if docs else np.zeros(0, dtype=np.uint64)
        sums: dict[bool, np.ndarray] = {}
        ranges: dict[tuple[int, int], set[int]] = {}
        for kind in self.classes if len(flat) else ():
            step, width = kind
            wide = width > 255
            if wide not in sums:
                sums[wide] = _sums(flat, wide)
            at, hit = self.near(prints(sums[wide], width, step), kind)
            _, places, offsets, _ = self.classes[kind]
            at = at * step
            doc = np.searchsorted(ends, at, side="right")
            inside = at + width <= ends[doc]
            start = at - (ends[doc] - sizes[doc]) - offsets[hit]
            for d, place, s in zip(doc[inside].tolist(), places[hit[inside]].tolist(), start[inside].tolist()):
                ranges.setdefault((d, place), set()).add(s)
        best: list[list[tuple[int, float, int]]] = [[] for _ in docs]
        for (d, place), starts in ranges.items():
            v = self.items[place][1]
            s, start = best_span(docs[d], v, _around(sorted(starts), slack(len(v), threshold) + 1, len(v), len(docs[d])))
            if s >= threshold:
                best[d].append((place, s, start))
        return [[{"item_id": self.items[p][0], "similarity": s, "start_word": start, "n_words": len(self.items[p][1])} for p, s, start in sorted(found)] for found in best]


def _around(starts: list[int], reach: int, n: int, size: int) -> list[tuple[int, int]]:
    """Ranges of starts within ``reach`` of some, merged where they meet; at least a word of the text stays in each span."""
    out: list[tuple[int, int]] = []
    for s in starts:
        lo, hi = max(1 - n, s - reach), min(size - 1, s + reach)
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _type(key: DataType) -> ArrayType:
    return ArrayType(StructType([StructField("item_id", key), StructField("similarity", DoubleType()), StructField("start_word", IntegerType()), StructField("n_words", IntegerType())]))


_index: OrderedDict[tuple, Index] = OrderedDict()


def _indexed(key: tuple, items: list, threshold: float) -> Index:
    """The index of some items, made once in a worker's life as long as the indexes have room."""
    if key not in _index:
        _index[key] = Index(items, threshold)
        while len(_index) > 1 and sum(i.bytes for i in _index.values()) > KEPT:
            _index.popitem(last=False)
    return _index[key]


def _searcher(spark: SparkSession, items: list[tuple[object, str]], threshold: float, key: DataType):
    shared = spark.sparkContext.broadcast((hash((threshold, *items)), items))
    kind = _type(key)
    arrow = to_arrow_type(kind)

    @F.arrow_udf(kind)
    def search(texts: pa.Array) -> pa.Array:
        name, given = shared.value
        index = _indexed((name, threshold), given, threshold)
        out, held, size = [], [], 0
        for t in texts:  # one text at a time is a Python string
            held.append(words(t.as_py()))
            size += len(held[-1])
            if size >= WORDS:
                out += index.search(held)
                held, size = [], 0
        if held:
            out += index.search(held)
        return pa.array(out, arrow)

    return search


def matches(spark: SparkSession, benchmark: DataFrame, text: Column, threshold: float = THRESHOLD) -> Column:
    """A column: the benchmark items (item_id, text) that a text holds, with their best spans, by item."""
    items = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    groups = max(1, -(-n // ITEMS), -(-chars // ITEM_CHARS))
    out = []
    for g in range(groups):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).orderBy("item_id", "text").collect()
        out.append(_searcher(spark, [tuple(r) for r in part], threshold, items.schema["item_id"].dataType)(text))
    return out[0] if groups == 1 else F.flatten(F.array(*out))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, item_id, similarity, start_word, n_words): every item found in every document."""
    found = matches(docs.sparkSession, benchmark, F.col(text), threshold)
    return docs.select(F.col(key), F.explode(found).alias("m")).select(key, "m.*")


def op1_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contaminated documents with the items that they hold."""
    return leaks(docs, benchmark)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no benchmark item; the columns stay as they are."""
    name = fresh(docs, "matches")
    found = docs.withColumn(name, matches(docs.sparkSession, benchmark, F.col("text")))
    return found.filter(F.size(name) == 0).select(*docs.columns)
