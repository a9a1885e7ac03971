"""Operator 13 against a plain trie, and its spilling queue."""

import hashlib
import heapq
import random
import zlib

import pytest
from eventloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, conv string, pos long"


def brute(rows):
    """Sorted result rows of (conv_id, turn, role, text) rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2][:64], hashlib.md5((f"{len(t[1].encode())}:" + t[1] + t[2]).encode()).digest()))
    made = {}
    for c in own:
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = [t[1:] for t in own.get(first, [])[:h]] + [t[1:] for t in own[c][h:]]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    out = []
    for node, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(made[c]) == len(node))))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children.get(node, 0), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df, **options):
    return sorted((tuple(r) for r in prefix_trie.trie(df, **options).collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def made(n, seed):
    """Conversations with common openings, copies, negative ids, ties, repeated rows and nulls."""
    rng = random.Random(seed)
    rows = []
    for c in range(-n // 3, n):
        if rng.random() < 0.2:
            continue
        for t in range(rng.choice([1, 2, 3, 3, 3, 9, 12])):
            text = rng.choice(["a", "b", "é" * 3, None, ""]) if rng.random() < 0.7 else f"t{c}"
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None]), text))
    return rows + rows[:5] + [(None, 1, "user", "x"), (7, None, None, None)]


@pytest.mark.parametrize("options", [{}, {"shard": 2, "growth": 3, "queue": 2}, {"shard": 20, "growth": 4, "queue": 1}])
def test_equals_a_plain_trie(spark, options):
    rows = made(150, 1)
    assert result(table(spark, rows), **options) == brute(rows)


def test_given_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert result(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_small_and_empty_tables(spark):
    for rows in ([], [(None, 1, "a", "b")], [(1, 1, "user", "hello")], [(i, 0, "user", "same") for i in range(40)]):
        assert result(table(spark, rows)) == brute(rows)


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    rows = [(c, t, "user", f"{t if t < 90 - c else c}" * 3) for c in (5, 6, 7, 10) for t in range(120)] + [(8, 0, "user", "long " * 400_000)]
    assert result(table(spark, rows)) == brute(rows)


def test_queue_spills_and_keeps_order():
    rng, queue, heap = random.Random(2), prefix_trie.SpillingQueue(10), []
    for _ in range(3000):
        if rng.random() < 0.6 or not heap:
            m = (rng.randint(-50, 50), rng.randint(0, 9), 0, 1, 2)
            queue.push(m)
            heapq.heappush(heap, m)
        else:
            assert queue.first() == heap[0] and queue.pop() == heapq.heappop(heap)
    while heap:
        assert queue.pop() == heapq.heappop(heap)
    assert queue.first() is None and queue.runs > 20
