"""Histories that come in pages, newest first, as a Python data source over stored pages.

Pages are JSON objects: ``rows`` with the fields of ``SCHEMA`` (a time as text
or as ``time_ms``, milliseconds since 1970), and ``next``, the name of the page
after it.  Numbered pages are read by ranges of pages, a partition each; a
chain of cursors is one partition, as a page's place is only known from the
page before.  The range of days is the reader's own: it gives no other rows, and
ends a partition at the first page whose oldest row is before the range.  An
``index`` of the pages' days, where the collector has written one, spares the
reader all pages outside of the range.

Edges: a page that isn't there ends its partition, as a source without more
pages does; a malformed page is an error; rows without a readable time or title
are left out; of equal addresses the first row stays, within a page.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "title string, content string, publish_time string, url string, category string, page string"


def _time(row: dict) -> str:
    """The row's time as text, from text or milliseconds; empty if there is none."""
    text = str(row.get("publish_time") or "").strip().replace("/", "-")
    if text or row.get("time_ms") in (None, ""):
        return text
    try:
        return datetime.fromtimestamp(int(row["time_ms"]) / 1000, UTC).strftime("%Y-%m-%d %H:%M:%S")
    except (TypeError, ValueError, OverflowError):
        return ""


class Pages(InputPartition):
    """Names of pages to read in order, or the first of a chain."""

    def __init__(self, names: list[str], chained: bool):
        super().__init__(0)
        self.names, self.chained = names, chained


class PageReader(DataSourceReader):
    """Reads one range of pages in each partition."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.start, self.end = options.get("start", ""), options.get("end", "9999")
        self.size, self.cursor = int(options.get("pages_per_partition", 16)), options.get("cursor", "")

    def _open(self, name: str) -> str | None:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(f"{self.path}/{name}")
        try:
            with system.open_input_stream(path) as f:
                return f.read().decode("utf-8-sig")
        except FileNotFoundError:
            return None

    def partitions(self) -> list[Pages]:
        if self.cursor:
            return [Pages([self.cursor], True)]
        index = self._open("index.json")
        if index is not None:
            names = [p["page"] for p in json.loads(index) if p["newest"][:10] >= self.start and p["oldest"][:10] <= self.end]
        else:
            names = self._listed()
        return [Pages(names[i : i + self.size], False) for i in range(0, len(names), self.size)]

    def _listed(self) -> list[str]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.path)
        found = [f.base_name for f in system.get_file_info(fs.FileSelector(path)) if f.base_name.endswith(".json") and f.base_name != "index.json"]
        return sorted(found, key=lambda n: (len(n), n))

    def read(self, partition: Pages) -> Iterator[tuple]:
        names = list(partition.names)
        while names:
            name = names.pop(0)
            source = self._open(name)
            if source is None:
                return
            page, seen, oldest = json.loads(source), set(), None
            for row in page.get("rows") or []:
                time, title, url = _time(row), str(row.get("title") or "").strip(), str(row.get("url") or "").strip()
                if not time or not title:
                    continue
                oldest = time[:10] if oldest is None else min(oldest, time[:10])
                if self.start <= time[:10] <= self.end and not (url and url in seen):
                    seen.add(url)
                    yield title, str(row.get("content") or ""), time, url, str(row.get("category") or ""), name
            if oldest is not None and oldest < self.start:
                return
            if partition.chained and page.get("next"):
                names.append(str(page["next"]))


class PagedHistory(DataSource):
    """The format ``paged_history``: options path, start and end (days), pages_per_partition, cursor (the first page of a chain)."""

    @classmethod
    def name(cls) -> str:
        return "paged_history"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))


def history(spark: SparkSession, path: str, start: str = "", end: str = "9999", **options: str) -> DataFrame:
    """Rows of stored pages of some days."""
    spark.dataSource.register(PagedHistory)
    return spark.read.format("paged_history").options(path=path, start=start, end=end, **options).load()


def write_pages(rows: DataFrame, path: str, size: int, order: list, with_index: bool = True) -> None:
    """Stores rows with the columns of the pages' rows as numbered pages of ``size`` rows, newest first, with an index of their days.

    Pages are written where their rows are, one after another; the index has a
    row for each page.
    """
    from ..operators.upsert import numbered

    made = rows.withColumn("_order", F.struct(*order))
    placed = numbered(made, "_order", "_place").drop("_order").withColumn("_page", F.floor(F.col("_place") / size))
    columns = rows.columns

    def store(key, group):
        import json

        import pandas as pd
        from pyarrow import fs

        group = group.sort_values("_place")
        name = f"page-{int(key[0]) + 1}.json"
        system, place = fs.FileSystem.from_uri(f"{path.rstrip('/')}/{name}")
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        body = json.dumps({"rows": [{c: None if pd.isna(v) else v for c, v in zip(columns, r)} for r in group[columns].itertuples(index=False)]}, ensure_ascii=False)
        with system.open_output_stream(place) as f:
            f.write(body.encode())
        days = group["publish_time"].str.slice(0, 10)
        return pd.DataFrame([(int(key[0]), name, days.max(), days.min())], columns=["n", "page", "newest", "oldest"])

    pages = placed.groupBy("_page").applyInPandas(store, "n long, page string, newest string, oldest string").orderBy("n").collect()
    if with_index:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(f"{path.rstrip('/')}/index.json")
        with system.open_output_stream(place) as f:
            f.write(json.dumps([{"page": r.page, "newest": r.newest, "oldest": r.oldest} for r in pages]).encode())
