"""Run records: append-only rows of runs, steps and artifacts, and the latest state of each."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id string, step string, status string, at timestamp, rows long, message string, metadata map<string,string>"


def record(spark: SparkSession, path: str, run_id: str, step: str, status: str, at: datetime, rows: int | None = None, message: str = "", metadata: dict[str, str] | None = None) -> None:
    """Appends one record; nothing is updated in place."""
    if status not in ("running", "success", "failed"):
        raise ValueError(f"unknown status {status}")
    spark.createDataFrame([(run_id, step, status, at, rows, message, metadata or {})], RUN).coalesce(1).write.mode("append").parquet(path)


def new_run() -> str:
    """A fresh run id."""
    return uuid.uuid4().hex


def latest(records: DataFrame) -> DataFrame:
    """The last record of each run and step, with metadata of all its records merged, later ones winning."""
    order = F.array_sort(F.collect_list(F.struct("at", F.map_entries("metadata").alias("m"))))
    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    merged = F.aggregate(order, empty, lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, v: ~F.map_contains_key(F.map_from_entries(x["m"]), k)), F.map_from_entries(x["m"])))
    return records.groupBy("run_id", "step").agg(F.max_by("status", "at").alias("status"), F.max("at").alias("at"), F.max_by("rows", "at").alias("rows"), F.max_by("message", "at").alias("message"), merged.alias("metadata"))


def artifact(df: DataFrame, key: str) -> DataFrame:
    """(key, rows, content_hash): size and an order-free hash of a table's rows."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("content_hash")).select(F.lit(key).alias("key"), "rows", "content_hash")


def file_record(spark: SparkSession, key: str, path: str) -> DataFrame:
    """(key, rows, bytes, sha256) of a written text dataset: its lines, size, and the hash of its files' hashes in order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("h"))
    one = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "h"))), lambda x: x["h"]), "\n").cast("binary"), 256).alias("sha256"))
    rows = spark.read.option("recursiveFileLookup", "true").text(path).agg(F.count(F.lit(1)).alias("rows"))
    return rows.crossJoin(one).select(F.lit(key).alias("key"), "rows", "bytes", "sha256")  # two rows of aggregates


def versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Dataset versions by key and content hash: a new record takes the place of one with the same key and hash."""
    return old.join(new.select("key", "content_hash"), ["key", "content_hash"], "left_anti").unionByName(new.select(*old.columns))
