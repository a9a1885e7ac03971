"""The batch operators over streams: open work in micro-batches, daily counts, URL dedup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import Buckets


def classify_stream(documents: DataFrame, classify: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "url"):
    """Classifies rows whose key hasn't come before and adds them to ``out``; runs until all that is there is read.

    Known keys are state of the stream, so a batch reads nothing of what is
    stored.  A batch writes under its own number: run again after a failure, it
    replaces what it had written.
    """

    def step(batch: DataFrame, number: int) -> None:
        classify(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return documents.dropDuplicates([key]).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(events: DataFrame, time: str, by: str, late: str = "2 days") -> DataFrame:
    """Counts by day window and a column, for late rows up to ``late``."""
    return events.withWatermark(time, late).groupBy(F.window(time, "1 day"), by).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), by, "n")


def first_by_url(documents: DataFrame, time: str, late: str = "1 day") -> DataFrame:
    """The first document of each URL within the watermark."""
    return documents.withWatermark(time, late).dropDuplicatesWithinWatermark(["url"])


def of_the_past(documents: DataFrame, time: str, today: str) -> DataFrame:
    """Rows that aren't of the future, which a stream drops."""
    return documents.filter(F.to_date(time) <= F.lit(today).cast("date"))


def stored(spark, out: str, key: str, buckets: int = 64) -> DataFrame | None:
    """The table that ``flush_stream`` keeps, or None."""
    return Buckets(spark, out, [key], buckets).read()


def flush_stream(rows: DataFrame, key: str, order: str, out: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, rows_per_flush: int | None = None, buckets: int = 64):
    """Upserts each micro-batch into a keyed table of hash buckets, the last row of a key by ``order`` wins; late rows take their keys too.

    A flush rewrites the buckets that it touches.  ``rows_per_flush`` splits what
    a batch brings into flushes of about so many rows, by bucket, so that they
    touch different ones; there are at most ``buckets`` of them.  The last two
    versions stay.
    """
    from ..operators import upsert

    def step(batch: DataFrame, number: int) -> None:
        table = Buckets(batch.sparkSession, out, [key], buckets)
        new = upsert.last_wins(prepare(batch), [key], order)
        parts = 1 if rows_per_flush is None else min(buckets, max(1, -(-batch.count() // rows_per_flush)))
        for i in range(parts):
            part = new if parts == 1 else new.filter(table.of() % parts == i)
            table.update(number * buckets + i, part, lambda old, b: b if old is None else upsert.upserted(old, b, [key]))
        table.vacuum()

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_streaks(events: DataFrame, time: str, by: str, late: str = "3 days") -> DataFrame:
    """(by, first_day, days): runs of consecutive days with events, closed once the watermark is past them.

    A run is a session of day starts that lie no more than a day apart.
    """
    days = events.withColumn("_day", F.date_trunc("day", time)).withWatermark("_day", late)
    sessions = days.groupBy(F.session_window("_day", "25 hours").alias("s"), by).agg(F.count(F.lit(1)).alias("events"))
    last = F.to_date(F.col("s.end") - F.expr("INTERVAL 25 HOURS"))
    return sessions.select(by, F.to_date("s.start").alias("first_day"), (F.datediff(last, F.to_date("s.start")) + 1).alias("days"), "events")


def recomputed(events: DataFrame, by: list[str], snapshot: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, buckets: int = 64):
    """Keeps all rows in buckets of their groups and recomputes the snapshot of the groups' buckets that a batch touches, so late rows change past days.

    ``snapshot`` gives rows with the columns ``by``; ``current_snapshot`` reads
    the last complete one.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows, shown = Buckets(spark, f"{out}/rows", by, buckets), Buckets(spark, f"{out}/snapshot", by, buckets)
        rows.update(number, batch, lambda old, b: b if old is None else old.unionByName(b))
        touched = {r[0] for r in batch.select(rows.of()).distinct().collect()}
        now = rows.read(touched, number + 1) if touched else None
        shown.update(number, snapshot(batch.limit(0) if now is None else now), lambda _, new: new)
        rows.vacuum()
        shown.vacuum()

    return events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_snapshot(spark, out: str, by: list[str], buckets: int = 64) -> DataFrame | None:
    """The last complete snapshot of ``recomputed``."""
    return Buckets(spark, f"{out}/snapshot", by, buckets).read()
