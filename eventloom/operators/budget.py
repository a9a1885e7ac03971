"""Work in buckets within a budget of time: finished buckets stay, the next run does the rest."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import exists


def _done(spark: SparkSession, out: str, buckets: int) -> list[int]:
    return [b for b in range(buckets) if exists(spark, f"{out}/bucket={b}/_SUCCESS")]


def run(spark: SparkSession, work: Callable[[int], DataFrame], out: str, buckets: int, seconds: float) -> int:
    """Writes ``work(b)`` of each bucket that isn't finished under ``out`` until the time is over; how many are left.

    A bucket whose job runs when the time ends is cancelled by its tag and
    leaves nothing; an error of a job is raised.
    """
    deadline, context = time.monotonic() + seconds, spark.sparkContext
    finished = set(_done(spark, out, buckets))
    for b in range(buckets):
        rest = deadline - time.monotonic()
        if b in finished or rest <= 0:
            continue
        tag, over = f"eventloom-{uuid.uuid4().hex}", threading.Event()

        def stop(tag: str = tag, over: threading.Event = over) -> None:
            over.set()
            context.cancelJobsWithTag(tag)

        timer = threading.Timer(rest, stop)
        timer.daemon = True
        context.addJobTag(tag)
        timer.start()
        try:
            work(b).write.mode("overwrite").parquet(f"{out}/bucket={b}")
            finished.add(b)
        except Exception:
            if not over.is_set():
                raise
        finally:
            timer.cancel()
            context.removeJobTag(tag)
    return buckets - len(finished)


def results(spark: SparkSession, out: str, buckets: int) -> DataFrame | None:
    """The rows of all finished buckets."""
    there = _done(spark, out, buckets)
    return spark.read.option("basePath", out).parquet(*(f"{out}/bucket={b}" for b in there)).drop("bucket") if there else None


def bucket_of(df: DataFrame, column: str, buckets: int, bucket: int) -> DataFrame:
    """The rows of one bucket by the hash of a column."""
    return df.filter(F.pmod(F.xxhash64(column), F.lit(buckets)) == bucket)
