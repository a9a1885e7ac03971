"""Keyed tables in hash buckets: a batch rewrites the buckets that it touches, and readers switch when all are there.

Every batch writes its buckets under its own number, then a small table that
names each bucket's current number.  The latest of these that is complete is
the table, so a run killed in the middle leaves the old one, and a batch that is
run again writes the same.  ``vacuum`` removes what no kept table names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"


class Buckets:
    """One table of ``count`` buckets by the hash of some key columns."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], count: int = 64):
        self.spark, self.path, self.keys, self.count = spark, path.rstrip("/"), keys, count

    def of(self, columns: list[str] | None = None) -> Column:
        """A row's bucket."""
        return F.pmod(F.xxhash64(*(columns or self.keys)), F.lit(self.count)).cast("int")

    def versions(self) -> list[int]:
        """Numbers of the complete versions, in order."""
        return [n for n in self._numbers("current") if self._there(f"{self.path}/current/v={n}/_SUCCESS")]

    def _numbers(self, folder: str) -> list[int]:
        path = self._file(f"{self.path}/{folder}")
        fs = self._fs(path)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def _file(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _there(self, name: str) -> bool:
        path = self._file(name)
        return self._fs(path).exists(path)

    def current(self, before: int | None = None) -> dict[int, int]:
        """The number under which each bucket lies, as of the last version before a number."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return {}
        return {r.bucket: r.number for r in self.spark.read.parquet(f"{self.path}/current/v={known[-1]}").collect()}  # a row for each bucket

    def read(self, buckets: set[int] | None = None, before: int | None = None) -> DataFrame | None:
        """The table or some of its buckets; None if there are none."""
        found: dict[int, list[int]] = {}
        for b, number in self.current(before).items():
            if buckets is None or b in buckets:
                found.setdefault(number, []).append(b)
        parts = [self.spark.read.option("basePath", f"{self.path}/data/v={n}").parquet(*(f"{self.path}/data/v={n}/{BUCKET}={b}" for b in bs)).drop(BUCKET) for n, bs in sorted(found.items())]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def update(self, number: int, batch: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
        """Version ``number``: the batch's buckets hold ``merge(their old rows, the batch)``, all others stay as they are."""
        touched = {r[0] for r in batch.select(self.of()).distinct().collect()}  # at most ``count``
        now = self.current(number)
        if touched:
            rows = merge(self.read(touched, number), batch)
            place = f"{self.path}/data/v={number}"
            rows.withColumn(BUCKET, self.of()).repartition(F.col(BUCKET)).write.partitionBy(BUCKET).mode("overwrite").parquet(place)
            filled = {b for b in touched if self._there(f"{place}/{BUCKET}={b}")}
            now = {b: n for b, n in now.items() if b not in touched} | dict.fromkeys(filled, number)
        self.spark.createDataFrame([*now.items()], "bucket int, number long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/current/v={number}")

    def vacuum(self, keep: int = 2) -> None:
        """Removes all but the last versions and the buckets that these don't name."""
        known = self.versions()
        kept = known[-keep:]
        used = {n for v in kept for n in self.current(v + 1).values()}
        for n in self._numbers("data"):
            if n not in used and kept and n <= kept[-1]:
                self._delete(f"{self.path}/data/v={n}")
        for v in known[:-keep]:
            self._delete(f"{self.path}/current/v={v}")

    def _delete(self, name: str) -> None:
        path = self._file(name)
        self._fs(path).delete(path, True)
