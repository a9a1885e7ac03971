"""Operator 13: a prefix trie of conversations, with totals by time-forward processing.

Conversations get the places of their turns by exact numbers of sorted ranges,
and running sums over blocks of turns: each place carries the sum of the hashes
of the (place, role, text) so far, which names its node, and the bytes so far.
A node is one (depth, name); its smallest member stands for it.

Nodes with the same smallest member and the same number of members form a
chain without branches, so the tree of chains has at most two for each
conversation, however long conversations are.  Chains are cut into shards by
weight: the shards of a round are the largest subtrees with at most so many
members, a later round's many times as many, up to the whole trie.  In a shard
chains come in reverse level order from an external sort.  Each one takes what
its children have sent from a priority queue that spills to sorted runs, and
sends its own totals on; the shards' roots send theirs to the next round.

Edges: a null role or text is empty, null turns come first; equal turns are
ordered by role, then by the text's first 64 characters, then by its digest.  Rows without conv_id belong to no
conversation and are left out.  Repeated rows are turns of their own.  An empty
table has no nodes.  Texts of any length are hashed where they are read; a
conversation of any length is split over tasks.  Extra columns are ignored.
Two 50-bit sums name a node; conversations that differ get the same name with
odds below 1e-6 for 1e12 nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, numbered

#: Members of the largest subtree that is a shard in the first round, and how many times as many in each later one.
SHARD, GROWTH = 1024, 64
#: Turns of a block of running sums.
BLOCK = 4096
#: Messages that a priority queue keeps in memory.
QUEUE = 200_000
#: Ids in a piece of a list that is hashed.
PIECE = 8192
#: Hashes are cut to so many bits, so that sums of a block's don't overflow.
BITS = 50
#: Shared turns of a conversation: crc32 of its id modulo this.
SHARED = 9
#: Conversations c take their first turns from c - c % FAMILY.
FAMILY = 5

_MASK = (1 << BITS) - 1


def turns(df: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, pos, role_text, size): each turn's place from 0, a digest of role and text, and the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn"), role.alias("role"), F.substring(text, 1, 64).alias("begin"), F.octet_length(text).cast("long").alias("size"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("role_text"),
    )
    return numbered(slim, scratch, "conv", ["turn", "role", "begin", "role_text"]).select("conv", "pos", "role_text", "size")


def rebuilt(own: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns with new places from 1, and the conversations with the number of their rebuilt turns.

    A conversation begins with the first turns of its family's first one, then
    comes what it has after as many of its own.
    """
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED
    lengths = own.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumn("h", share).withColumn("first", F.col("conv") - F.col("conv") % FAMILY)
    lengths = scratch.put(lengths, "lengths")
    firsts = lengths.select(F.col("conv").alias("first"), F.col("n").alias("first_n"))
    convs = lengths.join(firsts, "first", "left").withColumn("taken", F.least("h", F.coalesce("first_n", F.lit(0))))
    convs = scratch.put(convs.select("conv", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "conversations")
    # a first conversation's members differ from it by less than FAMILY; below 0 remainders are negative
    offsets = F.explode(F.array(*(F.lit(k) for k in range(1 - FAMILY, FAMILY))))
    opening = own.filter((F.col("conv") % FAMILY == 0) & (F.col("pos") < SHARED)).select("*", offsets.alias("k"))
    opening = opening.withColumn("member", F.try_add("conv", "k")).filter(F.col("member") - F.col("member") % FAMILY == F.col("conv"))
    taken = opening.join(convs.select(F.col("conv").alias("member"), "taken"), "member").filter("pos < taken").select(F.col("member").alias("conv"), (F.col("pos") + 1).alias("depth"), "role_text", "size")
    kept = own.join(convs.select("conv", "h", "taken"), "conv").filter("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "role_text", "size")
    return taken.unionByName(kept), convs


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, depth, a, b, up_a, up_b, size, upto): names of each place's node and of the one before, and bytes so far.

    Sums run over blocks of turns; sums of blocks run over blocks of blocks, and
    so on while a conversation has more than one.
    """
    half = [F.xxhash64(F.lit(k), "depth", "role_text").bitwiseAND(F.lit(_MASK)) for k in (1, 2)]
    rows = turns.select("conv", "depth", "size", half[0].alias("own_a"), half[1].alias("own_b"), F.floor((F.col("depth") - 1) / BLOCK).alias("block"))
    return scratch.put(_running(rows, "depth", scratch).select(
        "conv", "depth", "a", "b", (F.col("a") - F.col("own_a")).bitwiseAND(F.lit(_MASK)).alias("up_a"), (F.col("b") - F.col("own_b")).bitwiseAND(F.lit(_MASK)).alias("up_b"), "size", "upto",
    ), "prefixes")


def _running(rows: DataFrame, order: str, scratch: Scratch) -> DataFrame:
    """``rows`` with running sums a, b (of own_a, own_b, cut to BITS) and upto (of size) of each conversation."""
    within = Window.partitionBy("conv", "block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.withColumns({"a": F.sum("own_a").over(within), "b": F.sum("own_b").over(within), "upto": F.sum("size").over(within)})
    if rows.filter("block > 0").isEmpty():
        return sums.withColumns({c: F.col(c).bitwiseAND(F.lit(_MASK)) for c in ("a", "b")})
    sums = scratch.put(sums, "sums")
    totals = sums.groupBy("conv", "block").agg(*(F.max_by(c, order).bitwiseAND(F.lit(_MASK)).alias(o) for c, o in (("a", "own_a"), ("b", "own_b"))), F.max("upto").alias("size"))
    blocks = totals.withColumn("inner", F.col("block")).withColumn("block", F.floor(F.col("block") / BLOCK))
    before = _running(blocks, "inner", scratch).select("conv", F.col("inner").alias("block"), *((F.col(c) - F.col(o)).alias(f"before_{c}") for c, o in (("a", "own_a"), ("b", "own_b"), ("upto", "size"))))
    joined = sums.join(before, ["conv", "block"])
    return joined.withColumns({"a": (F.col("a") + F.col("before_a")).bitwiseAND(F.lit(_MASK)), "b": (F.col("b") + F.col("before_b")).bitwiseAND(F.lit(_MASK)), "upto": F.col("upto") + F.col("before_upto")})


def trie_nodes(places: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, a, b, up_a, up_b, conv_id, n_convs, size, upto) of each node; the root has depth 0 and no text."""
    below = places.groupBy("depth", "a", "b").agg(*(F.max(c).alias(c) for c in ("up_a", "up_b", "size", "upto")), F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("up_a"), zero.alias("up_b"), zero.alias("size"), zero.alias("upto"), "conv_id", "n_convs")
    return below.unionByName(root)


def chains_of(nodes: DataFrame) -> DataFrame:
    """One row for each run of nodes with the same members, by (conv_id, n_convs): its ends, and the bytes that it saves."""
    top, bottom = F.min(F.struct("depth", "a", "b", "up_a", "up_b", (F.col("upto") - F.col("size")).alias("before"))), F.max(F.struct("depth", "a", "b", "upto"))
    found = nodes.groupBy("conv_id", "n_convs").agg(top.alias("top"), bottom.alias("bottom"))
    return found.withColumn("own_saved", (F.col("n_convs") - 1) * (F.col("bottom.upto") - F.col("top.before")))


def ends_digests(places: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """(depth, a, b, ends_sha256) of each node where conversations end.

    Ids are sorted by range and written into pieces of a node's ids that follow
    each other, so that the task that hashes a node's list reads few rows.
    """
    zero = F.lit(0).cast("long")
    last = places.join(convs.select("conv", F.col("length").alias("depth")), ["conv", "depth"]).select("depth", "a", "b", "conv")
    ends = last.unionByName(convs.filter("length = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv"))
    pieces = ends.repartitionByRange("conv").sortWithinPartitions("depth", "a", "b", "conv").mapInArrow(_pieces, "depth bigint, a bigint, b bigint, first bigint, ids string")
    dealt = scratch.put(pieces, "pieces").repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "first")
    return dealt.mapInArrow(_hashed, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])

    def rows():
        node, ids = None, []
        for *at, conv in _rows(batches):
            if at != node or len(ids) == PIECE:
                if ids:
                    yield *node, ids[0], ",".join(map(str, ids))
                node, ids = at, []
            ids.append(conv)
        if ids:
            yield *node, ids[0], ",".join(map(str, ids))

    return _batches(rows(), schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        node, digest = None, None
        for *at, _, ids in _rows(batches):
            if at != node:
                if node is not None:
                    yield *node, digest.hexdigest()
                node, digest = at, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if node is not None:
            yield *node, digest.hexdigest()

    return _batches(rows(), pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept = []
    for row in rows:
        kept.append(row)
        if len(kept) == 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)
            kept = []
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)


class SpillingQueue:
    """A priority queue of tuples that writes its messages to a sorted run when there are many.

    Runs are temporary files of the task, read again from front to back as the
    queue is emptied; a task that starts anew makes its own.
    """

    def __init__(self, most: int = QUEUE):
        self.most = most
        self.heap: list[tuple] = []
        self.fronts: list[tuple] = []  # (first message, run, file) of each run
        self.runs = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.most:
            self.heap.sort()
            run = tempfile.TemporaryFile()  # noqa: SIM115  closed with the run's end or the queue
            for m in self.heap:
                pickle.dump(m, run, protocol=5)
            run.seek(0)
            self.heap = []
            self._advance(self.runs, run)
            self.runs += 1

    def _advance(self, number: int, run) -> None:
        try:
            heapq.heappush(self.fronts, (pickle.load(run), number, run))
        except EOFError:
            run.close()

    def first(self) -> tuple | None:
        """The smallest message, which stays."""
        if self.fronts and (not self.heap or self.fronts[0][0] <= self.heap[0]):
            return self.fronts[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.fronts and (not self.heap or self.fronts[0][0] <= self.heap[0]):
            message, number, run = heapq.heappop(self.fronts)
            self._advance(number, run)
            return message
        return heapq.heappop(self.heap)


TOTALS = "conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, outward boolean, up_depth bigint, up_a bigint, up_b bigint"
_TOTALS = pa.schema([(x.split()[0], pa.bool_() if x.endswith("boolean") else pa.int64()) for x in TOTALS.split(", ")])


def _time_forward(queue: int) -> Callable:
    """Chains in reverse level order, deepest first; a chain's totals go to its parent as a message to the parent's bottom node."""

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            waiting = SpillingQueue(queue)
            for conv, n, depth, a, b, up_depth, up_a, up_b, children, leaves, saved, outward in _rows(batches):
                address = (-depth, a, b)
                while (message := waiting.first()) is not None and message[:3] == address:
                    waiting.pop()
                    children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
                leaves = leaves or 1
                if not outward:
                    waiting.push((-up_depth, up_a, up_b, leaves, saved))
                yield conv, n, children, leaves, saved, outward, up_depth, up_a, up_b
            if waiting.first() is not None:
                raise RuntimeError("a message has no receiver")

        return _batches(rows(), _TOTALS)

    return process


def totals(chains: DataFrame, places: DataFrame, scratch: Scratch, n_convs: int, shard: int = SHARD, growth: int = GROWTH, queue: int = QUEUE) -> DataFrame:
    """(conv_id, n_convs, n_children, n_leaves, saved) of each chain: counts of its bottom node, saved bytes of its whole subtree."""
    sizes = [shard]
    while sizes[-1] < n_convs:
        sizes.append(sizes[-1] * growth)
    heavy = chains.filter(F.col("n_convs") > sizes[0]).select("n_convs", *(F.col(f"bottom.{c}").alias(f"up_{c}") for c in ("depth", "a", "b")))
    passed = places.withColumn("up_depth", F.col("depth") - 1).join(heavy, ["up_depth", "up_a", "up_b"])
    name = F.struct("depth", "a", "b")
    tops = [F.max(F.when(F.col("n_convs") > s, name)).alias(f"shard_{i}") for i, s in enumerate(sizes[:-1])]
    dealt = chains
    if tops:  # the first light node on a conversation's way is the root of its shard, for each round
        shards = passed.groupBy(F.col("conv").alias("conv_id")).agg(*tops)
        dealt = scratch.put(chains.join(shards, "conv_id", "left"), "shards")
    done, low = [], 0
    for i, size in enumerate(sizes):
        own = dealt.filter((F.col("n_convs") > low) & (F.col("n_convs") <= size))
        low = size
        root = F.col(f"shard_{i}") if i < len(sizes) - 1 else F.struct(*(F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b")))
        top = F.struct(*(F.col(f"top.{c}").alias(c) for c in ("depth", "a", "b")))
        own = own.select("conv_id", "n_convs", *(F.col(f"bottom.{c}").alias(c) for c in ("depth", "a", "b")), (F.col("top.depth") - 1).alias("up_depth"), F.col("top.up_a").alias("up_a"), F.col("top.up_b").alias("up_b"), F.col("own_saved").alias("saved"), root.alias("shard"), (top == root).alias("outward"))
        if done:
            sent = reduce(DataFrame.unionByName, done).filter("outward").groupBy(F.col("up_depth").alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
            sent = sent.agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("sent"))
            own = own.join(sent, ["depth", "a", "b"], "left").withColumn("saved", F.col("saved") + F.coalesce("sent", F.lit(0)))
        else:
            own = own.withColumns({c: F.lit(None).cast("long") for c in ("n_children", "n_leaves")})
        columns = ["conv_id", "n_convs", "depth", "a", "b", "up_depth", "up_a", "up_b", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_children", "n_leaves")), "saved", "outward"]
        ordered = own.repartition("shard").sortWithinPartitions(F.desc("depth"), "a", "b").select(*columns)
        done.append(scratch.put(ordered.mapInArrow(_time_forward(queue), TOTALS), f"round{i}"))
    return reduce(DataFrame.unionByName, done)


def trie(df: DataFrame, shard: int = SHARD, growth: int = GROWTH, queue: int = QUEUE) -> DataFrame:
    """Every node of the trie of ``df``'s rebuilt conversations with its counts; see ``op13_prefix_trie``."""
    scratch = Scratch(df.sparkSession, "trie")
    rows, convs = rebuilt(scratch.put(turns(df, scratch), "turns"), scratch)
    places = prefixes(rows, scratch)
    nodes = scratch.put(trie_nodes(places, convs), "nodes")
    chains = scratch.put(chains_of(nodes), "chains")
    found = totals(chains, places, scratch, convs.count(), shard, growth, queue)
    parents = chains.select(F.col("conv_id").alias("above"), *(F.col(f"bottom.{c}").alias(f"up_{c}") for c in ("depth", "a", "b")))
    ends = ends_digests(places, convs, scratch)
    ends = ends.select(*(F.col(c).alias(f"at_{c}") for c in ("depth", "a", "b")), "ends_sha256")
    full = chains.select("conv_id", "n_convs", "own_saved", F.col("top.depth").alias("top"), (F.col("top.depth") - 1).alias("up_depth"), F.col("top.up_a").alias("up_a"), F.col("top.up_b").alias("up_b"), F.col("top.before").alias("before"), *(F.col(f"bottom.{c}").alias(f"at_{c}") for c in ("depth", "a", "b")))
    full = full.join(found.drop("outward", "up_depth", "up_a", "up_b"), ["conv_id", "n_convs"])
    full = full.join(ends, ["at_depth", "at_a", "at_b"], "left").join(parents, ["up_depth", "up_a", "up_b"], "left")
    full = scratch.put(full.select("conv_id", "n_convs", "top", "at_depth", "before", "above", "n_children", "n_leaves", "saved", "ends_sha256"), "full")
    joined = nodes.select("conv_id", "n_convs", "depth", (F.col("upto") - F.col("size")).alias("upto")).join(full, ["conv_id", "n_convs"])
    bottom = F.col("depth") == F.col("at_depth")
    return joined.select(
        "conv_id", "depth",
        F.when(F.col("depth") == F.col("top"), F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(bottom, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * (F.col("upto") - F.col("before"))).alias("saved_tokens"),
        F.coalesce(F.when(bottom, F.col("ends_sha256")), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op13_prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node."""
    return trie(conversations)
