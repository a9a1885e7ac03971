"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, lossless decoding.

Words are found without regular expressions.  Every code point gets a class
from a table; a look at its neighbours refines apostrophes and the last white
space of a run.  The eight states of the splitter then advance by one
transition function for each class.  Composition of such functions is
associative and their closure is a small monoid, so a chunk of text is cut
into rows, each row is folded to one function, the functions are scanned, and
all rows run at once from the states that the scan gives.

Edge cases: null text is the empty text and has no ids; a text longer than a
chunk is read in slices that carry the splitter's state and the unfinished word,
so its ids are those of the whole text; special tokens are ordinary text; equal
rows have equal results; ties of rank go to the leftmost pair; an empty table
gives an empty table; ``encode`` replaces a column that has the output's name.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LETTER, NUMBER, OTHER, APOS1, APOS2, JOIN, SPACE, LAST, CUT = range(9)
BEGIN, IN_LETTER, IN_NUMBER, IN_OTHER, JOINED, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)
STATES, CLASSES = 8, 9
#: Code points that one vectorised pass takes.
CHUNK = 1 << 18
ROW = 256
#: Code points after a slice that the pattern looks at.
AHEAD = 2
#: Words, and their code points, that a worker remembers before it starts anew, looked at once a chunk.
CACHE, CACHE_POINTS = 120_000, 4 << 20
#: Bytes of a word up to which new words are merged side by side.
SHORT = 48


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a word starts at this code point."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return BEGIN, False
    if kind in (LETTER, NUMBER, OTHER):
        inside = {LETTER: IN_LETTER, NUMBER: IN_NUMBER, OTHER: IN_OTHER}[kind]
        return inside, state not in (inside, JOINED)
    if kind in (APOS1, APOS2):
        if state in (IN_OTHER, JOINED):
            return IN_OTHER, False
        return (ONE_LEFT if kind == APOS1 else TWO_LEFT), True
    if kind == JOIN:
        return JOINED, True
    if kind == SPACE:
        return IN_SPACE, state != IN_SPACE
    return BEGIN, True  # LAST, CUT


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Function of each class, composition table, and the functions' values by state."""
    of = [tuple(_step(s, k)[0] for s in range(STATES)) for k in range(CLASSES)]
    known = {tuple(range(STATES)): 0}
    queue = [tuple(range(STATES))]
    while queue:
        f = queue.pop()
        for g in of:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    every = sorted(known, key=known.get)
    then = np.array([[known[tuple(g[x] for x in f)] for g in every] for f in every], dtype=np.uint16)
    return np.array([known[f] for f in of], dtype=np.uint16), then, np.array(every, dtype=np.uint8)


FUNCTION, THEN, VALUES = _monoid()
NEXT = np.array([[_step(s, k)[0] for k in range(CLASSES)] for s in range(STATES)], dtype=np.uint8).ravel()
STARTS = np.array([[_step(s, k)[1] for k in range(CLASSES)] for s in range(STATES)], dtype=bool).ravel()

#: More than any id.
NONE = np.int64(1 << 62)

_class_table: np.ndarray | None = None


def class_table() -> np.ndarray:
    """The class of each code point by its Unicode category; CUT is what follows the last."""
    global _class_table
    if _class_table is None:
        kinds = {"L": LETTER, "N": NUMBER}
        out = np.full(sys.maxunicode + 2, OTHER, dtype=np.uint8)
        for c in range(sys.maxunicode + 1):
            k = kinds.get(unicodedata.category(chr(c))[0])
            if k is not None:
                out[c] = k
        # Unicode's White_Space property
        white = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
        out[white] = SPACE
        out[sys.maxunicode + 1] = CUT
        _class_table = out
    return _class_table


def classes(points: np.ndarray) -> np.ndarray:
    """Classes of code points, refined by the neighbours that the pattern looks at."""
    kind = class_table()[points]
    after = np.append(kind[1:], np.uint8(CUT))
    last = (kind == SPACE) & (after != SPACE) & (after != CUT)
    apos = np.flatnonzero(points == 0x27)
    kind[last] = np.where(points[last] == 0x20, JOIN, LAST)
    if len(apos):
        padded = np.append(points, [0, 0])
        a, b = padded[apos + 1], padded[apos + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        kind[apos[one]] = APOS1
        kind[apos[two]] = APOS2
    return kind


def starts(points: np.ndarray, at: int = BEGIN, ahead: int = 0) -> tuple[np.ndarray, int]:
    """Positions at which a word starts, by a scan of transition functions, and the state at the end.

    ``at`` is the state before the first; the last ``ahead`` points are only looked at.
    """
    n = len(points) - ahead
    if n <= 0:
        return np.zeros(0, dtype=np.int64), at
    kind = classes(points)[:n]
    rows = -(-n // ROW)
    grid = np.full(rows * ROW, CUT, dtype=np.uint8)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T)
    m = len(THEN)
    then = THEN.ravel()
    whole = FUNCTION[grid[0]].astype(np.intp)
    for j in range(1, ROW):
        whole = then[whole * m + FUNCTION[grid[j]]].astype(np.intp)
    state = np.zeros(rows, dtype=np.intp)
    for r, f in enumerate(whole.tolist()):  # the scan over the rows' functions
        state[r] = at
        at = int(VALUES[f][at])
    last = n - (rows - 1) * ROW  # real points of the last row
    marks = np.empty((ROW, rows), dtype=bool)
    for j in range(ROW):
        key = state * CLASSES + grid[j]
        marks[j] = STARTS[key]
        state = NEXT[key].astype(np.intp)
        if j + 1 == last:
            at = int(state[-1])
    return np.flatnonzero(marks.T.reshape(-1)[:n]), at


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def word_slices(text: str, size: int = CHUNK):
    """The words of a text in order, in lists for about ``size`` code points each."""
    state, held = BEGIN, ""
    for a in range(0, len(text), size):
        part = text[a : a + size]
        after = text[a + size : a + size + AHEAD]
        at, state = starts(_points(part + after), state, len(after))
        if not len(at):
            held += part
            continue
        bounds = at.tolist()
        words = [part[x:y] for x, y in zip(bounds, bounds[1:])]
        first = held + part[: bounds[0]]
        yield [first, *words] if first else words
        held = part[bounds[-1] :]
    if held:
        yield [held]


class Codec:
    """Ranks of a vocabulary, with the merged ids of words seen lately."""

    def __init__(self, content: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        self.pieces = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        #: Word to its place in first and size; these point into store.
        self.cache: dict[str, int] = {}
        self.cached_points = 0
        self.first, self.size = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.store, self.used = np.zeros(1 << 14, dtype=np.int32), 0
        self.pair_keys: np.ndarray | None = None
        self.bytes = Strings(self.pieces)
        self.decimals = Strings([b"%d " % i for i in range(len(self.pieces))])

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one word: the pair of lowest rank, the leftmost of these, is joined first."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        if len(piece) > 200:
            return self._merge_long(piece)
        get, none = ranks.get, 1 << 60
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same by a heap over a linked list, so that a very long word isn't quadratic."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # the part that begins at i is piece[i:end[i]]
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            gone = end[i]
            alive[gone] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def _pair_table(self) -> None:
        """Pairs of ids whose pieces join to a piece: sorted keys, and the id of each joined piece."""
        ranks, keys, joined = self.ranks, [], []
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a = ranks.get(piece[:i])
                b = ranks.get(piece[i:]) if a is not None else None
                if b is not None:
                    keys.append(a << 32 | b)
                    joined.append(rank)
        keys, joined = np.array(keys, dtype=np.int64), np.array(joined, dtype=np.int64)
        order = np.argsort(keys)
        # one more key than any, so that every place that a search gives is there
        self.pair_keys, self.pair_ids = np.append(keys[order], np.iinfo(np.int64).max), np.append(joined[order], NONE)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)

    def _joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ids of joined pairs, NONE where a pair is no piece."""
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ids[at], NONE)

    def merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of short words in a row, and how many each word has; a step joins one pair in every word that has one."""
        if self.pair_keys is None:
            self._pair_table()
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        of = np.repeat(np.arange(len(words)), sizes)  # the word of each id
        pair = np.full(len(ids), NONE)  # the id of each id joined with the next
        inside = np.flatnonzero(of[1:] == of[:-1])
        pair[inside] = self._joined(ids[inside], ids[inside + 1])
        done = []
        while len(ids):
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            n = np.diff(np.append(first, len(of)))
            low = np.repeat(np.minimum.reduceat(pair, first), n)
            ended = low == NONE
            if ended.any():
                done.append((of[ended], ids[ended]))
                ids, of, pair, low = (x[~ended] for x in (ids, of, pair, low))
                if not len(ids):
                    break
            at = np.flatnonzero(pair == low)
            at = at[np.append(True, of[at[1:]] != of[at[:-1]])]  # the leftmost of each word
            ids[at] = pair[at]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, of, pair = ids[keep], of[keep], pair[keep]
            at = at - np.arange(len(at))
            for x in (at, at[at > 0] - 1):  # pairs with the new id on the left and on the right
                x = x[x + 1 < len(ids)] if len(x) else x
                same = of[x] == of[x + 1]
                pair[x] = np.where(same, self._joined(ids[x], ids[x + 1]), NONE)
            if len(ids) and at[-1] == len(ids) - 1:
                pair[-1] = NONE
        of, ids = (np.concatenate([d[i] for d in done]) if done else np.zeros(0, dtype=np.int64) for i in (0, 1))
        order = np.argsort(of, kind="stable")
        return ids[order], np.bincount(of, minlength=len(words))

    def _remember(self, pieces: list[str]) -> None:
        """Merges words that aren't remembered yet, and remembers them."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        short = [i for i, w in enumerate(raw) if len(w) <= SHORT]
        ids, sizes = self.merge_many([raw[i] for i in short])
        order = [*short]
        if len(short) < len(raw):
            there = set(short)
            long = [i for i in range(len(raw)) if i not in there]
            more = [self.merge(raw[i]) for i in long]
            ids, sizes = np.concatenate([ids, *more]).astype(np.int64), np.append(sizes, [len(m) for m in more])
            order += long
        at, used = len(self.cache), self.used
        while at + len(order) > len(self.size):
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        while used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[used : used + len(ids)] = ids
        ends = used + np.cumsum(sizes)
        self.size[at : at + len(order)] = sizes
        self.first[at : at + len(order)] = ends - sizes
        self.used = used + len(ids)
        self.cache.update(zip((pieces[i] for i in order), range(at, at + len(order))))
        self.cached_points += sum(map(len, pieces))

    def words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        cache = self.cache
        if len(cache) > CACHE or self.cached_points > CACHE_POINTS:
            cache.clear()
            self.used = self.cached_points = 0
            self.store = self.store[: 1 << 20]
        found = np.fromiter(map(cache.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        new = np.flatnonzero(found < 0).tolist()
        if new:
            self._remember(list(dict.fromkeys(pieces[i] for i in new)))
            found[new] = [cache[pieces[i]] for i in new]
        sizes = self.size[found]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.store[np.arange(total) + np.repeat(self.first[found] - ends + sizes, sizes)], sizes

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts in one array, and how many each text has."""
        if not texts:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        if len(texts) == 1:
            ids = [i for _, i in self.slices(texts[0])] or [np.zeros(0, dtype=np.int32)]
            return np.concatenate(ids), np.array([sum(map(len, ids))])
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        joined = "".join(texts)
        plain = _points(joined)
        ends = np.cumsum(lengths)
        cuts = ends + np.arange(len(texts))  # a cut stands after each text
        points = np.full(len(plain) + len(texts), sys.maxunicode + 1, dtype=np.uint32)
        inside = np.ones(len(points), dtype=bool)
        inside[cuts] = False
        points[inside] = plain
        at, _ = starts(points)
        at = at[points[at] <= sys.maxunicode]
        text_of = np.searchsorted(cuts, at)
        real = at - text_of
        bounds = np.append(real, len(plain)).tolist()
        ids, sizes = self.words([joined[a:b] for a, b in zip(bounds, bounds[1:])])
        per_text = np.bincount(text_of, weights=sizes, minlength=len(texts)).astype(np.int64)
        return ids, per_text

    def slices(self, text: str):
        """(words, ids) of a long text, slice by slice."""
        for words in word_slices(text):
            yield words, self.words(words)[0]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of some ids, as an array."""
        return self.bytes.joined(ids)

    def digests(self, texts: list[str]):
        """(number of ids, sha256 of their decimals, sha256 of the decoded bytes) of each text."""
        if len(texts) == 1 and len(texts[0]) > CHUNK:
            n, of_ids, of_bytes, gap = 0, hashlib.sha256(), hashlib.sha256(), b""
            for _, ids in self.slices(texts[0]):
                n += len(ids)
                of_ids.update(gap)
                of_ids.update(self.decimals.joined(ids)[:-1].data)
                of_bytes.update(self.decode(ids).data)
                gap = b" "
            yield n, of_ids.hexdigest(), of_bytes.hexdigest()
            return
        ids, counts = self.encode_texts(texts)
        ends = np.cumsum(counts)
        bounds = np.concatenate([[0], ends])
        parts = []
        for strings, trim in ((self.decimals, 1), (self.bytes, 0)):
            sizes = np.concatenate([[0], np.cumsum(strings.lengths[ids])])[bounds].tolist()
            data = memoryview(strings.joined(ids))
            parts.append([hashlib.sha256(data[a : max(a, b - trim)]).hexdigest() for a, b in zip(sizes, sizes[1:])])
        yield from zip(counts.tolist(), *parts)


class Strings:
    """Byte strings by number, joined by array gathers."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(x) for x in strings], dtype=np.int64)
        self.bytes = np.frombuffer(b"".join(strings), dtype=np.uint8)
        self.places = np.cumsum(self.lengths) - self.lengths

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.places[ids] - ends + sizes, sizes)]


_codecs: dict[int, Codec] = {}


def codec(content: bytes) -> Codec:
    """The codec of a vocabulary's content, one for each Python worker."""
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def chunks(texts: pa.Array):
    """Runs of texts of about CHUNK code points, at least one text each; only one run is Python strings at a time."""
    batch, size = [], 0
    for t in texts:
        t = t.as_py() or ""
        if batch and size + len(t) > CHUNK:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += len(t)
    if batch:
        yield batch


ENCODED = "struct<ids:array<int>,offsets:array<int>>"


def _vocabulary(spark: SparkSession, vocab_path: str | None):
    """The vocabulary file's bytes for the executors; its size is that of the file, checked here."""
    if vocab_path is None:
        import public_tokenizers

        vocab_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(vocab_path, "rb") as f:
        content = f.read()
    if len(content) > 64 << 20:
        raise ValueError("a vocabulary of over 64 MB isn't broadcast")
    return spark.sparkContext.broadcast(content)


def encoder(spark: SparkSession, vocab_path: str | None = None):
    """A column function: text to struct(ids, offsets); offsets are each id's first byte in the text's UTF-8."""
    shared = _vocabulary(spark, vocab_path)

    @F.arrow_udf(ENCODED)
    def encode(texts: pa.Array) -> pa.Array:
        coder = codec(shared.value)
        ids, counts, firsts = [], [], []
        for batch in chunks(texts):
            a, b = coder.encode_texts(batch)
            before = np.cumsum(coder.bytes.lengths[a]) - coder.bytes.lengths[a]
            start = np.cumsum(b) - b
            firsts.append((before - np.repeat(before[start[b > 0]], b[b > 0])).astype(np.int32))
            ids.append(a.astype(np.int32))
            counts.append(b)
        lists = [_lists(x, counts) for x in (ids, firsts)]
        return pa.StructArray.from_arrays(lists, names=["ids", "offsets"])

    return encode


def _lists(parts: list[np.ndarray], counts: list[np.ndarray]) -> pa.ListArray:
    """Lists of so many values of some arrays in a row; the arrays are let go."""
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
    parts.clear()
    bounds = np.concatenate([[0], *counts]).cumsum().astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def id_encoder(spark: SparkSession, vocab_path: str | None = None):
    """A column function: text to ids alone."""
    shared = _vocabulary(spark, vocab_path)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        coder = codec(shared.value)
        ids, counts = [], []
        for batch in chunks(texts):
            a, b = coder.encode_texts(batch)
            ids.append(a.astype(np.int32))
            counts.append(b)
        return _lists(ids, counts)

    return encode


def decoder(spark: SparkSession, vocab_path: str | None = None):
    """A column function: array of ids to the text's bytes; null ids give null."""
    shared = _vocabulary(spark, vocab_path)

    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        coder = codec(shared.value)
        bounds, flat = ids.offsets.to_pylist(), ids.values.to_numpy(zero_copy_only=False)
        valid = ids.is_valid().to_pylist()
        return pa.array([coder.decode(flat[a:b]).tobytes() if ok else None for a, b, ok in zip(bounds, bounds[1:], valid)], pa.binary())

    return decode


def digester(spark: SparkSession, vocab_path: str | None = None):
    """A column function: text to struct(n_tokens, ids_sha256, decoded_sha256); the ids stay in the worker, chunk by chunk."""
    shared = _vocabulary(spark, vocab_path)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(texts: pa.Array) -> pa.Array:
        coder = codec(shared.value)
        rows = [row for batch in chunks(texts) for row in coder.digests(batch)]
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
        return pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encode(df: DataFrame, text: str = "text", out: str = "encoded", vocab_path: str | None = None) -> DataFrame:
    """``df`` with a column ``out``: struct(ids, offsets) of the whole text."""
    return df.withColumn(out, encoder(df.sparkSession, vocab_path)(F.coalesce(F.col(text), F.lit(""))))


def op9_byte_bpe(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """Digest of each document's ids and of the bytes that they decode to."""
    found = digester(docs.sparkSession, vocab_path)(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", found.alias("d")).select("doc_id", "d.*")
