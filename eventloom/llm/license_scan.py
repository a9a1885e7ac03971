"""License scan: MinHash bands over overlapping windows, then exact containment; DataFrame operations only.

Templates are (license_id, text) rows.  Each falls in a class of span ``m``
words, at least its own length, from a geometric series; windows of 2 m words
start every m words, so any run of up to m words lies whole in a window.  A
window that holds all of a template's shingles has a Jaccard similarity with it
of at least shingles / (2 m - 4); ``bands_for`` takes as many one-row MinHash
bands as make a common minimum likely with probability TARGET.  Candidates are
verified exactly: the share of the template's shingles found in the window.

Only windows with an anchor word are signed: anchors are words picked so that
every shingle of every template holds one, and a window without any shares no
shingle with any template, so nothing is lost.

Edge cases: words are split at white space, lowered, without outer punctuation;
templates with fewer words than a shingle are one shingle of all of them, and
match windows of as many; null and empty texts, and templates without words,
match nothing; rows with equal id and text are one document; whole texts are
scanned; ties between windows go to the earliest; templates repeated are one; no
template means no result; further columns of both tables don't matter.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

SHINGLE = 5
CONTAINED = 0.8
TARGET = 0.995
SMALLEST_SPAN, GROWTH = 8, 1.5
#: Frequent words that are anchors only where a shingle has no other.
COMMON = frozenset("a an and any are as at be by for from has have in is it its not of on or that the their this to was which will with you your".split())
#: Templates of one scan; more are scanned in further passes.
TEMPLATES = 2000

# Short notices of public licences, as their owners ask to have them written.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def builtin_templates(spark: SparkSession) -> DataFrame:
    """The notices above as (license_id, text)."""
    return spark.createDataFrame(NOTICES, "license_id string, text string")


def words(text: Column) -> Column:
    """Lowered words without punctuation around them."""
    return F.filter(F.transform(F.split(F.lower(text), "\\s+"), lambda w: F.regexp_replace(w, "^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$", "")), lambda w: w != "")


def shingles(ws: Column, size: int) -> Column:
    """Distinct hashes of the runs of ``size`` words, of all words where there are fewer."""
    at = F.sequence(F.lit(1), F.greatest(F.size(ws) - size + 1, F.lit(1)))
    return F.when(F.size(ws) > 0, F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(ws, i, size), " "))))).otherwise(F.array().cast("array<bigint>"))


def minima(hashes: Column, bands: int) -> Column:
    """(band, low): in each band the least of the hashes under the band's own hash function."""
    low = lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda band: F.struct(band.alias("band"), low(band).alias("low")))


def bands_for(shingles_of: int, span: int, size: int) -> int:
    """One-row bands with which a window that holds the template collides with probability TARGET."""
    similar = min(1.0, CONTAINED * shingles_of / max(1, 2 * span - size + 1))
    return 1 if similar >= 1 else ceil(log(1 - TARGET) / log(1 - similar))


def span_of(n: int) -> int:
    """The class of a template of n words."""
    span = SMALLEST_SPAN
    while span < n:
        span = ceil(span * GROWTH)
    return span


def anchors(texts: list[list[str]]) -> list[str]:
    """Words such that every run of SHINGLE words of every text holds one: greedily the word in most runs, longer ones first."""
    runs = [frozenset(t[i : i + SHINGLE]) for t in texts for i in range(max(1, len(t) - SHINGLE + 1)) if t]
    out = []
    while runs:
        score: dict[str, float] = {}
        for r in runs:
            for w in r:
                score[w] = score.get(w, 0) + (0.01 if w in COMMON else min(len(w), 8) ** 2)
        best = max(sorted(score), key=score.get)
        out.append(best)
        runs = [r for r in runs if best not in r]
    return out


def _scan(docs: DataFrame, templates: list[tuple[str, str, list[str]]]) -> DataFrame:
    spark = docs.sparkSession
    found = anchors([t[2] for t in templates])
    classes: dict[tuple[int, int], list] = {}
    for t in templates:
        if t[2]:
            classes.setdefault((span_of(len(t[2])), min(SHINGLE, len(t[2]))), []).append(t)
    low = docs.withColumn("low", F.lower("text"))
    holding = low.filter(reduce(lambda x, y: x | y, [F.col("low").contains(w) for w in found])).select("row", words(F.col("text")).alias("ws"))
    holding = Scratch(spark, "licenses").put(holding, "holding")  # read once for each class
    is_anchor = F.array(*[F.lit(w) for w in found])
    out = None
    for (span, size), members in sorted(classes.items()):
        table = spark.createDataFrame([(i, t[0], t[1]) for i, t in enumerate(members)], "template int, license_id string, notice string")
        table = table.withColumn("ts", shingles(words(F.col("notice")), size))
        bands = max(bands_for(max(1, len(t[2]) - size + 1), span, size) for t in members)
        # the last window may be short; one that is part of the one before isn't needed
        start = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("ws") / span) - 2, F.lit(0)).cast("int"))
        windows = holding.select("row", F.explode(F.transform(start, lambda k: F.struct((k * span).alias("first_word"), F.slice("ws", k * span + 1, 2 * span).alias("w")))).alias("x")).select("row", "x.*")
        windows = windows.filter(F.arrays_overlap("w", is_anchor)).select("row", "first_word", shingles(F.col("w"), size).alias("ws"))
        signed = windows.select("row", "first_word", "ws", F.inline(minima(F.col("ws"), bands)))
        lookups = table.select("template", "license_id", "ts", F.inline(minima(F.col("ts"), bands)))
        pairs = signed.join(F.broadcast(lookups), ["band", "low"]).dropDuplicates(["row", "first_word", "template"])  # at most TEMPLATES x bands rows
        share = F.size(F.array_intersect("ts", "ws")) / F.size("ts")
        hits = pairs.select("row", "license_id", F.lit(span).alias("span"), "template", "first_word", share.alias("containment")).filter(F.col("containment") >= CONTAINED)
        out = hits if out is None else out.unionByName(hits)
    return out


def licenses(docs: DataFrame, templates: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, license_id, containment, first_word, n_windows): each license found in each document.

    ``first_word`` is where the best window starts; ``n_windows`` counts windows
    that hold one of the license's templates.
    """
    spark = docs.sparkSession
    templates = builtin_templates(spark) if templates is None else templates
    split = templates.select(F.col("license_id").cast("string"), "text", words(F.col("text")).alias("ws")).filter("text IS NOT NULL AND size(ws) > 0").distinct()
    n = split.count()
    groups = max(1, -(-n // TEMPLATES))
    docs = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash")).alias("row"), F.col(text).alias("text")).filter("text IS NOT NULL")
    out = None
    for g in range(groups):
        rows = split.filter(F.pmod(F.xxhash64("text"), F.lit(groups)) == g).orderBy("license_id", "text").collect()
        if rows:
            hits = _scan(docs, [(r[0], r[1], r[2]) for r in rows])
            out = hits if out is None else out.unionByName(hits)
    if out is None:
        return docs.select(F.col("row.key").alias(key), F.lit("").alias("license_id"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word"), F.lit(0).cast("long").alias("n_windows")).limit(0)
    best = F.max_by(F.struct("containment", "first_word"), F.struct("containment", -F.col("first_word")))
    found = out.groupBy("row", "license_id").agg(best.alias("b"), F.count_distinct("span", "first_word").alias("n_windows"))
    return found.select(F.col("row.key").alias(key), "license_id", "b.containment", "b.first_word", "n_windows")


def op4_license_scan(docs: DataFrame) -> DataFrame:
    """Every license notice found in every document."""
    return licenses(docs)
