"""What the operators of this folder share: tables, shared scratch tables, words."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space that separates words: space, and U+0009 to U+000D.
WORD_BREAKS = "[\\x20\\x09-\\x0D]+"

_own_roots: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Only where the setting is missing in a local session (a test), a folder of
    this machine is made once for the session; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        made = tempfile.TemporaryDirectory(prefix="eventloom-scratch-")
        atexit.register(made.cleanup)
        _own_roots[app] = f"file://{made.name}"
    return _own_roots[app]


_made: list[Scratch] = []


class Scratch:
    """Tables written to the shared folder to cut lineage; each is read back with its schema.

    Written tables outlive a lost executor, unlike a local checkpoint.  An
    operator drops what its result doesn't read; who has consumed a result
    drops the rest with ``drop_since``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/eventloom-{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._tables: list[tuple[str, DataFrame]] = []
        _made.append(self)

    def put(self, df: DataFrame, label: str) -> DataFrame:
        self._n += 1
        path = f"{self.base}/{self._n:03d}-{label}"
        schema = df.schema
        df.write.mode("overwrite").parquet(path)
        back = self.spark.read.schema(schema).parquet(path)
        self._tables.append((path, back))
        return back

    def keep(self, *tables: DataFrame) -> None:
        """Removes the files of all tables that ``put`` has returned but these."""
        for path, df in self._tables:
            if not any(df is t for t in tables):
                self._delete(path)
        self._tables = [(p, df) for p, df in self._tables if any(df is t for t in tables)]

    def drop(self) -> None:
        """Removes all files."""
        self._delete(self.base)
        self._tables = []

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def scratches() -> int:
    """How many scratch spaces there are now: a mark for ``drop_since``."""
    return len(_made)


def drop_since(mark: int) -> None:
    """Removes the scratch spaces made since a mark; what reads from them must have been consumed."""
    for s in _made[mark:]:
        s.drop()
    del _made[mark:]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have in any case of letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def crc_mod(column: str | Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; null counts as the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def word_bytes(text: str | None) -> list[bytes]:
    """A-Z lowered, split at WORD_BREAKS; bytes.lower and bytes.split touch ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def at_most(table: DataFrame, count: str, rows: int) -> DataFrame:
    """Rows of the highest counts, at most so many; counts of like size are in or out together."""
    level = F.floor(F.log2(F.col(count).cast("double")) * 8)
    sizes = sorted(((r[0], r[1]) for r in table.groupBy(level.alias("l")).agg(F.count(F.lit(1))).collect()), reverse=True)
    total, least = 0, None
    for value, n in sizes:
        total += n
        if total > rows:
            break
        least = value
    return table.filter(F.lit(False) if least is None else level >= least)


def numbered(df: DataFrame, scratch: Scratch, group: str, order: list[str], out: str = "pos") -> DataFrame:
    """``df`` with each row's place from 0 within its group, by ``order``; ``group`` has no nulls.

    Rows are sorted into ranges of (group, order) and written once, so a group
    of any size spreads over many tasks and every place refers to the same
    ranges; a group's rows of a range then get the count of its rows in the
    ranges before.  Rows that are equal in ``order`` come in the input's order.
    """
    tie, at, seq, first, n = (fresh(df, x) for x in ("tie", "range", "seq", "first", "n"))
    keys = [F.asc_nulls_first(c) for c in (group, *order, tie)]
    ranges = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = scratch.put(ranges.drop(tie).withColumns({at: F.spark_partition_id(), seq: F.monotonically_increasing_id()}), "ranges")
    counts = rows.groupBy(group, at).agg(F.min(seq).alias(first), F.count(F.lit(1)).alias(n))
    before = F.coalesce(F.sum(n).over(Window.partitionBy(group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(group, at, (before - F.col(first)).alias(first))
    return rows.join(offsets, [group, at]).withColumn(out, F.col(seq) + F.col(first)).drop(at, seq, first)
