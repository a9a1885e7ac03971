"""The corpus pipeline: each stage is written as Parquet and reread as the next one's documents.

Null and empty texts, and those without letters, go in the first stage; an empty
table gives empty stages; of copies and repeated rows those with the smallest id stay;
a row without an id passes through like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, decontam, jaccard, langid, line_dedup
from eventloom.llm.common import Scratch, drop_since, scratches, table

#: Language models, near-duplicate groups and doubled ranks are beyond SQL on whole tables; tests hold each stage against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text has a known language; the model learns from rows of ``docs`` with a language."""
    return langid.keep_known(docs, langid.fit(langid.training_rows(docs)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes later copies of repeated runs of lines; documents left without text go."""
    return line_dedup.keep_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each kept document with its id and source."""
    coded = docs.select("doc_id", "source", bpe.id_encoder(spark)(F.coalesce("text", F.lit(""))).alias("ids"))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark = scratches()
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        scratch.keep(docs)
        drop_since(mark)  # the stage's own tables; its rows are written
    return STAGES[-1][1](spark, docs, sf_dir)
