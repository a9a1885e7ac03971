"""Hidden Markov language model: distributed Baum-Welch, exact scaled forward likelihoods.

Tokens are words (A-Z lowered, split at ASCII white space) and one end token.
The symbols that the states emit are the SYMBOLS most frequent words, the end,
and CLASSES classes of all other words by their last bytes; a word of a class
has the share (c + 1) / (N' + V' + 1) of its class, where c, N' and V' are its
count, the class's tokens and its distinct words in the training texts, so
unseen words have a probability.  A text's score is the log10 of the forward
probability of its symbols times its words' shares in their classes.

Counts of all words come from all training texts by one shuffle.  Each pass of
Baum-Welch reads every training text: tasks run forward and backward over
batches of texts and give expected counts by symbol, which Spark sums.

Bounds: the driver holds states x symbols parameters, the SYMBOLS most frequent
words and up to KNOWN frequent ones, which tasks get by broadcast; counts of all
other words reach their texts by a join.  A pass keeps forward vectors of BLOCK
steps and those at the blocks' borders, whatever a text's length.  Tasks' sums
are added as decimals, so a run over the same partitions gives the same model.

Edge cases: null and empty texts are the end token alone; texts are scored
whole; with no training text the model is uniform and the base score counts
from zero; rows repeated with one id are scored each; equal texts have equal
scores; a null id counts as the empty text in the split.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Scratch, at_most, crc_mod, word_bytes

SYMBOLS, CLASSES, KNOWN = 4096, 1024, 400_000
STATES, PASSES, SEED = 8, 4, 11
GROUP = 300_000  # tokens in one vectorised pass over texts of like length
ABREAST = 64  # texts that a pass takes side by side, so that steps aren't too small
BLOCK = 2048  # steps whose forward vectors are kept at a time
#: What sums of tasks are added as.
EXACT = "decimal(38,10)"


def _class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def _counts(texts: DataFrame) -> DataFrame:
    """(w, c): words of a column of texts with their counts, summed in tasks before the shuffle."""

    def count(batches):
        seen: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["w", "c"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(word_bytes(t))
                if len(seen) > 400_000:
                    yield rows()
                    seen.clear()
        yield rows()

    return texts.mapInArrow(count, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


class _Known:
    """What is known of words: each word's place in a table, which a text's new words join together."""

    def __init__(self, vocabulary: Vocabulary):
        self.of = vocabulary
        self.place: dict[bytes, int] = {}
        self.columns = np.zeros((3, 1 << 12))  # log10(c + 1), share in the class, whether the word is known
        self.symbols = np.zeros(1 << 12, dtype=np.int16)

    def places(self, words: list[bytes]) -> np.ndarray:
        got = np.fromiter(map(self.place.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(got < 0).tolist()
        if missing:
            new = list(dict.fromkeys(words[i] for i in missing))
            self._add(new)
            got[missing] = [self.place[words[i]] for i in missing]
        return got

    def _add(self, new: list[bytes]) -> None:
        lo, hi = len(self.place), len(self.place) + len(new)
        while hi > self.columns.shape[1]:
            self.columns = np.concatenate([self.columns, np.zeros_like(self.columns)], axis=1)
            self.symbols = np.concatenate([self.symbols, np.zeros_like(self.symbols)])
        c = np.fromiter(map(self.of.counts.get, new, repeat(0)), dtype=np.float64, count=len(new))
        s = np.fromiter(map(self.of.symbol.get, new, repeat(-1)), dtype=np.int64, count=len(new))
        k = np.fromiter(map(_class_of, new), dtype=np.int64, count=len(new))
        logs = np.log10(c + 1.0)
        self.columns[0, lo:hi], self.columns[1, lo:hi], self.columns[2, lo:hi] = logs, np.where(s >= 0, 0.0, logs - self.of.log_share[k]), c > 0
        self.symbols[lo:hi] = np.where(s >= 0, s, SYMBOLS + k)
        self.place.update(zip(new, range(lo, hi)))


class Vocabulary:
    """The broadcast part of the counts, and each word's symbol; ``words`` begins with the symbols."""

    def __init__(self, words: list[bytes], counts: list[int], symbols: int, total: int, types: int, ends: int, class_tokens: np.ndarray, class_types: np.ndarray):
        self.counts = dict(zip(words, counts))
        self.total, self.types, self.ends = total, types, ends
        self.symbol = {w: i for i, w in enumerate(words[:symbols])}
        for w in words[:symbols]:
            class_tokens[_class_of(w)] -= self.counts[w]
            class_types[_class_of(w)] -= 1
        self.log_share = np.log10(class_tokens + class_types + 1.0)
        self.end = SYMBOLS + CLASSES
        self.size = self.end + 1

    def read(self, text: str | None):
        """Symbols; sums of log10(c + 1) and of class shares; known tokens; words whose count isn't here."""
        words = word_bytes(text)
        known = self.__dict__.get("_known")
        if known is None or len(known.place) > 300_000:
            known = self._known = _Known(self)
        at = known.places(words)
        logs, share, there = known.columns[:, at].sum(axis=1).tolist()
        rest = Counter(words[i] for i in np.flatnonzero(known.columns[2, at] == 0).tolist()) if there < len(words) else {}
        symbols = np.append(known.symbols[at], np.int16(self.end))
        return symbols, logs + float(np.log10(self.ends + 1.0)), share, int(there) + int(self.ends > 0), rest

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_known"}


def _read_texts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(row, held_out, n, symbols, logs, share, known, rest, times) of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema["id"].dataType
    schema = f"id {kind.simpleString()}, held_out boolean, n long, symbols binary, logs double, share double, known long, rest array<binary>, times array<int>"
    types = [to_arrow_type(kind), pa.bool_(), pa.int64(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches):
        voc = shared.value
        for batch in batches:
            out = []
            for i, held, t in zip(*(batch.column(k).to_pylist() for k in range(3))):
                s, logs, share, known, rest = voc.read(t)
                out.append((i, held, len(s), s.tobytes(), logs, share, known, list(rest), list(rest.values())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)] if out else [pa.array([], k) for k in types], names=names)

    return docs.mapInArrow(read, schema)


def groups(sequences: list[np.ndarray]):
    """Indices of texts of like length, longest first, with about GROUP tokens together; long texts with ABREAST at least, up to 8 times as many tokens."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    part, size = [], 0
    for i in order.tolist():
        part.append(i)
        size += len(sequences[i])
        if size >= GROUP and (len(part) >= ABREAST or size >= 8 * GROUP):
            yield part
            part, size = [], 0
    if part:
        yield part


class _Steps:
    """Symbols by time of texts sorted by falling length: each step has those still running."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences])
        self.flat = np.concatenate(sequences).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.running = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")

    def __len__(self) -> int:
        return len(self.running)

    def __getitem__(self, t: int) -> np.ndarray:
        return self.flat[self.first[: self.running[t]] + t]


def _advance(a: np.ndarray | None, o: np.ndarray, start, move, emit) -> tuple[np.ndarray, np.ndarray]:
    """The next scaled forward vectors, and their scales."""
    a = start * emit[o] if a is None else (a[: len(o)] @ move) * emit[o]
    s = a.sum(axis=1)
    return a / s[:, None], s


def forward(sequences: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Natural log likelihoods of texts sorted by falling length; ``emit`` is symbols x states."""
    steps, logs, a = _Steps(sequences), np.zeros(len(sequences)), None
    for t in range(len(steps)):
        a, s = _advance(a, steps[t], start, move, emit)
        logs[: len(s)] += np.log(s)
    return logs


def expected(sequences, start, move, emit, block: int = BLOCK):
    """Baum-Welch counts of one group: starts, moves, emissions by symbol, and the log likelihood.

    The forward pass keeps the vectors before each block of steps; the backward
    pass makes a block's vectors again.
    """
    steps, k = _Steps(sequences), len(start)
    total, a, before, kept = 0.0, None, [], None
    for t in range(len(steps)):
        if t % block == 0:
            before.append(a)
            kept = ([a], [], [])  # vectors, scales and symbols of the block; those of the last stay
        o = steps[t]
        a, s = _advance(a, o, start, move, emit)
        for held, x in zip(kept, (a, s, o)):
            held.append(x)
        total += float(np.log(s).sum())
    moves, emitted, b, first = np.zeros((k, k)), np.zeros((len(emit), k)), np.zeros((0, k)), None
    for i in range(len(before) - 1, -1, -1):
        lo, hi = i * block, min((i + 1) * block, len(steps))
        if kept is None:
            kept = ([before[i]], [], [steps[t] for t in range(lo, hi)])
            for o in kept[2]:
                a, s = _advance(kept[0][-1], o, start, move, emit)
                kept[0].append(a)
                kept[1].append(s)
        alphas, scales, symbols = kept
        kept = None
        gammas, rights = [None] * (hi - lo), [None] * (hi - lo)
        for t in range(hi - lo - 1, -1, -1):
            n = len(symbols[t])
            if len(b) < n:
                b = np.vstack([b, np.ones((n - len(b), k))])
            gammas[t] = alphas[t + 1] * b
            rights[t] = emit[symbols[t]] * b
            rights[t] /= scales[t][:, None]
            b = rights[t] @ move.T
        since = 1 if lo == 0 else 0  # nothing moves into the first step
        if hi - lo > since:
            moves += np.vstack([alphas[t][: len(symbols[t])] for t in range(since, hi - lo)]).T @ np.vstack(rights[since:])
        where, weights = np.concatenate(symbols), np.vstack(gammas)
        for j in range(k):
            emitted[:, j] += np.bincount(where, weights=weights[:, j], minlength=len(emit))
        first = gammas[0]
    return first.sum(axis=0), moves * move, emitted, total


def train(texts: DataFrame, size: int, states: int = STATES, passes: int = PASSES, seed: int = SEED) -> tuple:
    """(start, move, emit) after so many passes over a table with a column of symbols."""
    rng = np.random.default_rng(seed)
    spark = texts.sparkSession
    start, move = np.full(states, 1 / states), np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    emit = np.exp(rng.normal(0, 0.7, (size, states)))
    emit /= emit.sum(axis=0)
    columns = [f"x{j}" for j in range(states)]
    for _ in range(passes):
        shared = spark.sparkContext.broadcast((start, move, emit))

        def expect(batches, shared=shared):
            s, m, e = shared.value
            total = np.zeros((size + states + 2, states))  # emissions, moves, starts
            for batch in batches:
                sequences = [np.frombuffer(x, dtype=np.int16) for x in batch.column(0).to_pylist()]
                for part in groups(sequences):
                    a, b, c, _ = expected([sequences[i] for i in part], s, m, e)
                    total[:size] += c
                    total[size : size + states] += b
                    total[size + states] += a
            at = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, j]) for j in range(states))], names=["row", *columns])

        sums = texts.select("symbols").mapInArrow(expect, "row long, " + ", ".join(f"{c} double" for c in columns))
        sums = sums.groupBy("row").agg(*[F.sum(F.col(c).cast(EXACT)).cast("double").alias(c) for c in columns]).toPandas()
        total = np.zeros((size + states + 2, states))
        total[sums.row.to_numpy()] = sums[columns].to_numpy()
        base = total[:size].sum(axis=1) + 0.5
        base /= base.sum()
        emit = total[:size] + 20 * base[:, None]  # a little of the common distribution, so that no symbol is impossible
        emit /= emit.sum(axis=0)
        move = total[size : size + states] + 0.5
        move /= move.sum(axis=1, keepdims=True)
        start = total[size + states] + 0.5
        start /= start.sum()
        shared.unpersist()
    return start, move, emit


def score(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", states: int = STATES, passes: int = PASSES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each text.

    ``held_out`` is a boolean column; the other rows are learnt from.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "hmm")
    docs = docs.select(F.col(key).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    training = docs.filter(~F.col("held_out"))
    ends = training.count()
    counts = scratch.put(_counts(training.select("text")), "counts")
    of_class = F.crc32(F.expr("substring(w, greatest(octet_length(w) - 2, 1), 3)")) % CLASSES
    by_class = counts.groupBy(of_class.alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    class_tokens, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in by_class:
        class_tokens[r["k"]], class_types[r["k"]] = r["n"], r["v"]
    total, types = int(class_tokens.sum()) + ends, int(class_types.sum()) + (ends > 0)
    symbols = {bytes(r["w"]): r["c"] for r in counts.orderBy(F.desc("c"), "w").limit(SYMBOLS).collect()}  # the model's symbols
    known = {bytes(r["w"]): r["c"] for r in at_most(counts, "c", KNOWN).collect()}
    words = {**symbols, **known}
    vocabulary = Vocabulary(list(words), list(words.values()), len(symbols), total, types, ends, class_tokens, class_types)
    least = min(known.values(), default=None)
    read = scratch.put(_read_texts(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()), "read")
    size = vocabulary.size
    model = train(read.filter(~F.col("held_out")), size, states, passes)

    tail = read.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("w"), F.col("x.times").alias("k"))
    rare = counts if least is None else counts.filter(F.col("c") < least)
    tail = tail.join(rare, "w").groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("k").alias("seen"))
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def likelihood(symbols: pa.Array) -> pa.Array:
        sequences = [np.frombuffer(x, dtype=np.int16) for x in symbols.to_pylist()]
        out = np.zeros(len(sequences))
        for part in groups(sequences):
            out[part] = forward([sequences[i] for i in part], *shared.value)
        return pa.array(out / np.log(10))

    scored = read.withColumn("path", likelihood("symbols")).drop("symbols", "rest", "times").join(tail, "row", "left")
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    return scored.select(
        "id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + seen).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n") * F.log10(F.lit(float(total + types + 1)))).alias("base_score"), (F.col("path") + F.col("share") + more).alias("score"),
    )


def op3_hmm_score(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those whose crc32 of the id modulo 7 isn't 2."""
    return score(docs, crc_mod("doc_id", 7) == 2).withColumnRenamed("id", "doc_id")
