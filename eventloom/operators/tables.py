"""Tables that are written to cut lineage and to fix rows that a plan would otherwise compute twice."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local session without one gets a temporary folder, a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _folders:
        made = tempfile.TemporaryDirectory(prefix="eventloom-")
        atexit.register(made.cleanup)
        _folders[app] = f"file://{made.name}"
    return _folders[app]


def written(df: DataFrame, label: str = "rows") -> DataFrame:
    """``df`` written as a table of the shared folder and read back; it outlives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/eventloom-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task gets of a table that is dealt out by a key.
ROWS = 250_000


def dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt out by a key to so many tasks that none gets more when the table grows.

    For keys of few rows each: adaptive execution neither merges nor splits
    these partitions, and tables dealt by the same key and rows meet as they are.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS)), key)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have in any case of letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name
