"""Repeated runs of lines, by distributed prefix doubling; DataFrame operations only.

A line that isn't blank is a symbol, named by two 64-bit hashes.  Level 0 ranks symbols; level k + 1 ranks
runs of 2^(k + 1) lines by the sorted pairs of ranks at the run's start and
middle, as a suffix array is built.  Equal ranks are the suffixes that share
their first 2^k lines, which is an interval of longest common prefix; runs that
occur once get no rank and take no part in later levels.

A run of consecutive lines repeats if the same lines occur earlier (by id,
then position, overlaps included).  Deleted is every line that lies in a
repeated run of at least ``min_words`` words, so exactly the later copies of
maximal repeated runs go.  Such runs are covered by their shortest pieces of
``min_words`` words: those that start at a line and those that end at one; a
piece of m lines is named by the two ranks of 2^floor(log2 m) lines that cover
it.

Edge cases: null text stays null and has no lines; blank lines are no symbols
and stay where they are; rows with equal id and text are one document, so both
keep or lose the same lines; a null id sorts first; whole texts, any number of
lines; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_BREAKS, Scratch, fresh

MIN_WORDS = 50


def _lines(docs: DataFrame) -> DataFrame:
    """(d, th, seq, li, lh, lg, nw): the lines of each distinct id and text that aren't blank."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("li"), F.trim(F.translate(x, "\t\r\f\x0b", "    ")).alias("bare"), x.alias("line")))
    found = docs.select("d", "th", F.posexplode(F.filter(lines, lambda x: x.bare != "")).alias("seq", "x"))
    return found.select("d", "th", "seq", F.col("x.li").alias("li"), F.xxhash64("x.line").alias("lh"), F.xxhash64(F.lit(1), "x.line").alias("lg"), F.size(F.split("x.bare", WORD_BREAKS)).alias("nw"))


def _ranked(keys: DataFrame, *columns: str) -> DataFrame:
    """Distinct keys with an increasing number ``r`` in their order; written at once, so numbers stay."""
    return keys.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("r", F.monotonically_increasing_id())


RUNS = "array<struct<first:int,lines:int>>"


def _runs(lines: Column) -> Column:
    """Runs of consecutive lines of a sorted array of struct(i, li)."""
    start = F.struct(F.array().cast(RUNS).alias("done"), F.lit(None).cast("bigint").alias("i"))

    def add(acc, x):
        last = F.element_at(acc["done"], -1)
        longer = F.concat(F.slice(acc["done"], 1, F.size(acc["done"]) - 1), F.array(F.struct(last["first"].alias("first"), (last["lines"] + 1).alias("lines"))))
        fresh_run = F.concat(acc["done"], F.array(F.struct(x["li"].alias("first"), F.lit(1).alias("lines"))))
        return F.struct(F.when(x["i"] == acc["i"] + 1, longer).otherwise(fresh_run).alias("done"), x["i"].alias("i"))

    return F.aggregate(lines, start, add, lambda acc: acc["done"])


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(d, th, removed, runs): for documents that lose lines, their indices from 0 in the text's split by newline.

    ``d`` is the id, ``th`` the text's hash; ``runs`` are the maximal repeated
    runs, struct(first, lines): the index of the first line, and how many lines
    that aren't blank.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    docs = docs.select(F.col(key).alias("d"), F.xxhash64(text).alias("th"), F.col(text).alias("text")).filter("text IS NOT NULL")
    lines = _lines(docs)
    if not docs.groupBy("d", "th").count().filter("count > 1").isEmpty():
        lines = lines.dropDuplicates(["d", "th", "seq"])
    lines = scratch.put(lines, "lines")
    symbols = scratch.put(_ranked(lines.groupBy("lh", "lg").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("lh", "lg"), "lh", "lg"), "symbols")
    live = lines.join(symbols, ["lh", "lg"]).select(F.struct(F.col("d").isNotNull().alias("known"), "d", "th").alias("doc"), "seq", "li", "nw", "r")
    live = scratch.put(live, "live")

    by_doc = Window.partitionBy("doc").orderBy("seq")
    runs = live.withColumn("island", F.col("seq") - F.row_number().over(by_doc))
    runs = runs.withColumn("upto", F.sum(F.col("nw").cast("long")).over(by_doc)).withColumn("before", F.col("upto") - F.col("nw"))
    ahead = Window.partitionBy("doc", "island").orderBy("before").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy("doc", "island").orderBy("upto").rangeBetween(1 - min_words, 0)
    one = F.lit(1)
    runs = runs.select(
        "doc", "seq", F.count(one).over(ahead).alias("m1"), F.sum("nw").over(ahead).alias("w1"), F.count(one).over(behind).alias("m2"), F.sum("nw").over(behind).alias("w2")
    )
    from_here = F.when(F.col("w1") >= min_words, F.struct(F.col("seq").cast("long").alias("i"), F.col("m1").alias("m")))
    to_here = F.when(F.col("w2") >= min_words, F.struct((F.col("seq") - F.col("m2") + 1).alias("i"), F.col("m2").alias("m")))
    pieces = runs.select("doc", F.explode(F.array_distinct(F.array_compact(F.array(from_here, to_here)))).alias("x")).select("doc", "x.i", "x.m").distinct()
    pieces = scratch.put(pieces, "pieces")
    longest = pieces.agg(F.max("m")).first()[0] or 0

    hits, level, k = [], live.select("doc", F.col("seq").cast("long").alias("i"), "r"), 0
    while 1 << k <= longest:
        width = 1 << k
        start = level.select("doc", "i", F.col("r").alias("r1"))
        end = level.select("doc", F.col("i").alias("j"), F.col("r").alias("r2"))
        of_level = pieces.filter((F.col("m") >= width) & (F.col("m") < 2 * width)).join(start, ["doc", "i"])
        of_level = of_level.withColumn("j", F.col("i") + F.col("m") - width).join(end, ["doc", "j"])
        named = scratch.put(of_level.select("doc", "i", "m", "r1", "r2"), f"named{k}")
        first = named.groupBy("m", "r1", "r2").agg(F.min(F.struct("doc", "i")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("m", "r1", "r2", "first")
        first = scratch.put(first, f"first{k}")
        later = named.join(first, ["m", "r1", "r2"]).filter(F.struct("doc", "i") != F.col("first"))
        hits.append(later.select("doc", F.explode(F.sequence("i", F.col("i") + F.col("m") - 1)).alias("i")))
        k += 1
        if 1 << k > longest:
            break
        pairs = scratch.put(start.join(end.withColumn("i", F.col("j") - width), ["doc", "i"]).select("doc", "i", "r1", "r2"), f"pairs{k}")
        names = scratch.put(_ranked(pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("r1", "r2"), "r1", "r2"), f"names{k}")
        level = scratch.put(pairs.join(names, ["r1", "r2"]).select("doc", "i", "r"), f"level{k}")
        if level.isEmpty():
            break
    if not hits:
        return docs.select("d", "th", F.array().cast("array<int>").alias("removed"), F.array().cast(RUNS).alias("runs")).limit(0)
    gone = hits[0]
    for more in hits[1:]:
        gone = gone.unionByName(more)
    gone = gone.distinct().join(live.select("doc", F.col("seq").cast("long").alias("i"), "li"), ["doc", "i"])
    found = gone.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("i", "li"))).alias("x"))
    result = scratch.put(found.select("doc.d", "doc.th", F.transform("x", lambda x: x["li"]).alias("removed"), _runs(F.col("x")).alias("runs")), "removed")
    scratch.keep(result)
    return result


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, out: str = "removed", runs: str | None = None) -> DataFrame:
    """``docs`` with shortened texts and a column ``out``: indices of the lines that are gone, null if none; with ``runs``, also these."""
    gone = removed_lines(docs, key, text, min_words)
    d, th = fresh(docs, "_key"), fresh(docs, "_hash")
    more = [] if runs is None else [F.col("runs").alias(runs)]
    gone = gone.select(F.col("d").alias(d), F.col("th").alias(th), F.col("removed").alias(out), *more)
    # a merge join at every size: what is gone grows with the texts
    joined = docs.join(gone.hint("merge"), F.col(key).eqNullSafe(F.col(d)) & (F.xxhash64(docs[text]) == F.col(th)), "left")
    left = F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda x, i: ~F.array_contains(out, i)), "\n")
    return joined.withColumn(text, F.when(F.col(out).isNull(), F.col(text)).otherwise(left)).select(*docs.columns, out, *([] if runs is None else [runs]))


def op8_line_dedup(docs: DataFrame) -> DataFrame:
    """Every document's text without later copies of repeated runs of lines."""
    found = without_repeats(docs.select("doc_id", "text"), runs="runs")
    runs = F.array_join(F.transform("runs", lambda x: F.concat_ws("+", x["first"].cast("string"), x["lines"].cast("string"))), " ")
    return found.select("doc_id", "text", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), " ").alias("removed"), runs.alias("runs"))


def keep_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with shortened texts and their lengths; documents that lose all they had go."""
    name = fresh(docs, "removed")
    found = without_repeats(docs, out=name)
    found = found.filter(F.col(name).isNull() | F.col("text").rlike("[^\\s]"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col(name).isNull(), F.col("n_chars")).otherwise(length))
    return found.select(*docs.columns)
