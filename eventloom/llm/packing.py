"""Token ids as packed rows: best-fit-decreasing with a segment tree over free capacities.

Documents become ids (with an end id) and are packed into rows of ``length``
ids.  A longer document is split into whole rows and a rest; every part keeps
its document's id and its offset, so nothing is lost.  Parts of about
``window`` ids of one partition are packed together: longest first, each into
the open row with the least free room that takes it, which a segment tree over
capacities finds in logarithmic time.  Rows are independent, so packing runs in
every partition side by side with bounded memory.

A row holds: ``ids`` (little-endian, uint16 or uint32, padded to ``length``),
``cu_seqlens`` (0, then each segment's end), ``resets`` (where position ids
begin anew: each segment's start, and the padding's), and for each segment the
document's id and the offset of its first id in the document.

Edge cases: null and empty texts are one segment that holds the end id; a
document of exactly ``length`` ids fills a row; equal documents are packed each;
a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

LENGTH, WINDOW = 2048, 1 << 20
END = PAD = 50256  # free in the vocabulary


class Capacities:
    """Open rows by free room, in a segment tree that counts rows."""

    def __init__(self, most: int):
        self.n = 1 << most.bit_length()
        self.count = [0] * (2 * self.n)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _change(self, room: int, by: int) -> None:
        i = room + self.n
        while i:
            self.count[i] += by
            i >>= 1

    def add(self, room: int, row: int) -> None:
        """A row with so much room opens; a full one does not."""
        if room:
            self.rows[room].append(row)
            self._change(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``size``, and that room; it leaves the tree."""
        i = size + self.n
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.n:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.n
        self._change(room, -1)
        return self.rows[room].pop(), room


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indices into ``sizes``, by best fit decreasing; equal sizes keep their order."""
    tree, rows = Capacities(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        got = tree.take(sizes[i])
        if got is None:
            rows.append([i])
            tree.add(length - sizes[i], len(rows) - 1)
        else:
            rows[got[0]].append(i)
            tree.add(got[1] - sizes[i], got[0])
    return rows


SCHEMA = "row_id long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<{key}>, doc_offsets array<int>"


def _arrow(key: pa.DataType) -> pa.Schema:
    ints = pa.list_(pa.int32())
    return pa.schema([("row_id", pa.int64()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", ints), ("resets", ints), ("doc_ids", pa.list_(key)), ("doc_offsets", ints)])


def pack_rows(parts: list[tuple[object, int, np.ndarray]], length: int, first: int, kind: np.dtype, pad: int, schema: pa.Schema):
    """One Arrow batch of rows from (document, offset, ids) parts, numbered from ``first``."""
    out = []
    for k, row in enumerate(best_fit([len(p[2]) for p in parts], length)):
        chosen = [parts[i] for i in row]
        ends = np.cumsum([len(p[2]) for p in chosen])
        ids = np.full(length, pad, dtype=kind)
        ids[: ends[-1]] = np.concatenate([p[2] for p in chosen])
        cu = [0, *ends.tolist()]
        out.append((first + k, cu[-1], len(row), ids.tobytes(), cu, cu if cu[-1] < length else cu[:-1], [p[0] for p in chosen], [p[1] for p in chosen]))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema), len(out)


_tiktokens: dict = {}


def _tiktoken(content: bytes, pattern: str):
    if content not in _tiktokens:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        _tiktokens[content] = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _tiktokens[content]


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, window: int = WINDOW, end: int | None = END, pad: int = PAD, vocab_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Packed rows of all documents; the vocabulary is a rank file, its path a parameter."""
    if vocab_path is None or pattern is None:
        import public_tokenizers

        vocab_path, pattern = vocab_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    with open(vocab_path, "rb") as f:
        content = f.read()
    if len(content) > 64 << 20:
        raise ValueError("a vocabulary of over 64 MB isn't broadcast")
    highest = max([pad, end or 0, *(int(x.split()[1]) for x in content.splitlines())])
    kind = np.dtype("<u2" if highest < 1 << 16 else "<u4")
    shared = docs.sparkSession.sparkContext.broadcast(content)
    own = docs.schema[key].dataType
    schema = _arrow(to_arrow_type(own))

    def run(batches):
        from pyspark import TaskContext

        coder = _tiktoken(shared.value, pattern)
        number, parts, held = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):  # one text at a time is a Python string
                ids = np.asarray(coder.encode_ordinary(t.as_py() or ""), dtype=kind)
                if end is not None:
                    ids = np.append(ids, kind.type(end))
                for at in range(0, len(ids), length):
                    parts.append((doc, at, ids[at : at + length]))
                held += len(ids)
                if held >= window:
                    rows, n = pack_rows(parts, length, number, kind, pad, schema)
                    yield rows
                    number, parts, held = number + n, [], 0
        if parts:
            yield pack_rows(parts, length, number, kind, pad, schema)[0]

    return docs.select(key, text).mapInArrow(run, SCHEMA.format(key=own.simpleString()))


def write_packed(rows: DataFrame, path: str) -> None:
    """Writes the rows as Parquet: the column ``ids`` is the id matrix, one row of bytes each."""
    rows.write.mode("overwrite").parquet(path)


def position_ids(rows: DataFrame, length: int = LENGTH, out: str = "position_ids") -> DataFrame:
    """Packed rows with the position of each id in its segment, from the places where positions begin anew."""
    ends = F.concat(F.slice("resets", 2, F.greatest(F.size("resets") - 1, F.lit(0))), F.array(F.lit(length)))
    runs = F.transform(F.arrays_zip(F.col("resets").alias("a"), ends.alias("b")), lambda x: F.sequence(F.lit(0), x["b"] - x["a"] - 1))
    return rows.withColumn(out, F.flatten(runs))


def op6_pack_tokens(docs: DataFrame) -> DataFrame:
    """Packed rows of all documents, with a digest of each row's ids."""
    return packed(docs).withColumn("ids_sha256", F.sha2("ids", 256))
