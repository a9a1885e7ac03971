"""Document files in and out: CSV with a byte-order mark, JSON listings, HTML pages, text universes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import without_tags
from ..operators.companies import symbol_listing

DOCUMENT = ["source", "title", "content", "publish_time", "url", "symbol_or_subject"]
SEED_URL = "local://manual-seed"


def text_schema(columns: list[str]) -> StructType:
    """All columns as strings."""
    return StructType([StructField(c, StringType()) for c in columns])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def documents_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Documents of several CSV files; missing files are skipped, zero bytes removed, seed rows left out."""
    there = [p for p in paths if exists(spark, p)]
    if not there:
        return spark.createDataFrame([], text_schema(DOCUMENT))
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").schema(text_schema(DOCUMENT)).csv(there)
    clean = rows.select([F.regexp_replace(F.coalesce(c, F.lit("")), "\\x00", "").alias(c) for c in DOCUMENT])
    return clean.filter(F.col("url") != SEED_URL)


def write_csv(df: DataFrame, path: str, columns: list[str], files: int = 1) -> None:
    """Fixed columns as CSV with a header; nulls are blank."""
    df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).coalesce(files).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def listing(pages: DataFrame, body: str, items: str, fields: dict[str, str], inner: str | None = None) -> DataFrame:
    """Rows of a JSON listing: ``items`` is the path of a list, ``inner`` that of a list in each item, ``fields`` name to the path in an item."""
    one = pages.select(F.explode(F.from_json(F.get_json_object(body, items), "array<string>")).alias("item"))
    if inner is not None:
        one = one.select(F.explode(F.from_json(F.get_json_object("item", inner), "array<string>")).alias("item"))
    return one.select([F.get_json_object("item", p).alias(n) for n, p in fields.items()])


def blocks(pages: DataFrame, html: str, block: str, fields: dict[str, str], key: str | None = None) -> DataFrame:
    """Rows of a list page: one for each block that a pattern finds, with fields by patterns (first group) in it.

    Tags are stripped of all fields but ``key``, by which the first block of
    each page counts; blocks without a title are left out if there is one.
    """
    found = pages.select("*", F.posexplode(F.regexp_extract_all(html, F.lit(block), F.lit(0))).alias("_i", "_b"))
    cut = {n: F.regexp_extract("_b", p, 1) for n, p in fields.items()}
    rows = found.withColumns({n: F.trim(c) if n == key else without_tags(c) for n, c in cut.items()})
    if "title" in fields:
        rows = rows.filter(F.col("title") != "")
    if key is not None:
        first = rows.groupBy(*pages.columns, key).agg(F.min("_i").alias("_i"))
        rows = rows.join(first, [*pages.columns, key, "_i"], "left_semi")
    return rows.drop("_i", "_b")


def series_lines(pages: DataFrame, body: str, path: str, fields: list[str]) -> DataFrame:
    """Rows of a JSON list of comma-separated lines: the first parts by name."""
    lines = pages.select("*", F.explode(F.from_json(F.get_json_object(body, path), "array<string>")).alias("_l"))
    return lines.select(*pages.columns, *[F.get(F.split("_l", ","), F.lit(i)).alias(f) for i, f in enumerate(fields)])


def cached_series(text: DataFrame, body: str) -> DataFrame:
    """(key, source, day, value) of a JSON cache of series; values that are no numbers are dropped, a malformed cache is empty."""
    kind = "struct<series:map<string,struct<source:string,returns:map<string,string>>>>"
    one = text.select(F.explode(F.from_json(body, kind)["series"]).alias("key", "s"))
    rows = one.select("key", F.col("s.source").alias("source"), F.explode("s.returns").alias("day", "v"))
    return rows.select("key", "source", "day", F.col("v").try_cast("double").alias("value")).filter("value IS NOT NULL")


def series_cache(rows: DataFrame) -> DataFrame:
    """(body): one JSON cache of (key, source, day, value) for an exchange of a few series; ``store_series`` keeps any number."""
    by = rows.groupBy("key").agg(F.struct(F.max("source").alias("source"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("day", "value")))).alias("returns")).alias("s"))
    return by.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("key", "s"))).alias("series"))).alias("body"))


SERIES_BUCKETS = 64


def store_series(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Puts (key, source, day, value) rows into a table of series; days that a series has are replaced, others stay.

    The table lies in buckets by key and day, so a long series is no single row
    or file, and only buckets with new days are written.
    """
    from ..operators import upsert
    from ..streaming.buckets import Buckets

    keys = ["key", "day"]
    table = Buckets(spark, path, keys, SERIES_BUCKETS)
    new = upsert.last_wins(rows.select("key", "source", "day", F.col("value").cast("string").alias("value")), keys, "value")
    table.update(max(table.versions(), default=-1) + 1, new, lambda old, b: b if old is None else upsert.upserted(old, b, keys))
    table.vacuum()


def stored_series(spark: SparkSession, path: str) -> DataFrame | None:
    """(key, source, day, value) of a table of series, None if there is none; values that are no numbers are dropped."""
    from ..streaming.buckets import Buckets

    rows = Buckets(spark, path, ["key", "day"], SERIES_BUCKETS).read()
    return None if rows is None else rows.select("key", "source", "day", F.col("value").try_cast("double").alias("value")).filter("value IS NOT NULL")


def health(text: DataFrame, body: str) -> DataFrame:
    """(source, consecutive_failures, skip_until_ts, last_failure_category, last_error, updated_at) of a JSON health record; malformed ones are empty."""
    kind = "struct<sources:map<string,struct<consecutive_failures:string,skip_until_ts:string,last_failure_category:string,last_error:string,updated_at:string>>>"
    one = text.select(F.explode(F.from_json(body, kind)["sources"]).alias("source", "s")).filter("s IS NOT NULL")
    whole = lambda c: F.coalesce(F.col(f"s.{c}").try_cast("double").cast("long"), F.lit(0).cast("long")).alias(c)
    return one.select("source", whole("consecutive_failures"), whole("skip_until_ts"), *[F.coalesce(f"s.{c}", F.lit("")).alias(c) for c in ("last_failure_category", "last_error", "updated_at")])


def after_run(state: DataFrame, report: DataFrame, now: int, failures: int = 3, cooldown: int = 1800) -> DataFrame:
    """Health after a run's report (source, failure_category, error): successes reset, the third failure in a row starts a cooldown."""
    joined = state.join(report, "source", "full")
    failed = F.coalesce("failure_category", F.lit("")) != ""
    n = F.when(F.col("failure_category").isNull(), F.coalesce("consecutive_failures", F.lit(0))).when(failed, F.coalesce("consecutive_failures", F.lit(0)) + 1).otherwise(0).cast("long")
    until = F.when(F.col("failure_category").isNull(), F.coalesce("skip_until_ts", F.lit(0))).when(failed & (n >= failures), F.lit(now + cooldown)).otherwise(0).cast("long")
    return joined.select("source", n.alias("consecutive_failures"), until.alias("skip_until_ts"), F.coalesce("failure_category", "last_failure_category", F.lit("")).alias("last_failure_category"), F.coalesce("error", "last_error", F.lit("")).alias("last_error"))


def top_failures(report: DataFrame, top_n: int) -> DataFrame:
    """(collector, failure_category, n) of a report's failures, the most frequent first."""
    bad = report.filter(F.lower(F.coalesce("success", F.lit(""))) != "true")
    return bad.groupBy("collector", "failure_category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "collector", "failure_category").limit(top_n)


def links_of(html: Column, pattern: str) -> Column:
    """Distinct first groups of a pattern in a page."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)))


def meta_content(html: Column, name: str) -> Column:
    """Content of a meta tag by its name."""
    return F.regexp_extract(html, f'(?i)<meta[^>]*name=["\\\']{name}["\\\'][^>]*content=["\\\']([^"\\\']*)', 1)


def article(pages: DataFrame, html: str) -> DataFrame:
    """``pages`` with title and body text by tag patterns."""
    title = without_tags(F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1))
    body = without_tags(F.regexp_extract(html, "(?is)<article[^>]*>(.*?)(?:</article>|\\z)", 1))
    return pages.withColumns({"title": title, "body": body})


def universe(spark: SparkSession, path: str, limit: int, offset: int = 0) -> DataFrame:
    """Listing codes of a file, the first of each, in order: the code column of a CSV with a header, else all words.

    A first line with a comma and a column named ts_code, symbol or code makes a CSV.
    """
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\\uFEFF", "").alias("t"))
    lines = F.filter(F.transform(F.split("t", "\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    head = F.transform(F.split(F.lower(F.get(lines, F.lit(0))), ","), lambda x: F.trim(x))
    at = F.greatest(*[F.array_position(head, n) for n in ("ts_code", "symbol", "code")])
    rows = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.trim(F.coalesce(F.get(F.split(x, ","), (at - 1).cast("int")), F.lit(""))))
    found = whole.select(F.posexplode(F.when(at > 0, rows).otherwise(F.split("t", "[,\\s]+"))).alias("n", "code"))
    codes = found.withColumn("code", symbol_listing(F.col("code"))).filter(F.col("code") != "").groupBy("code").agg(F.min("n").alias("n"))
    return codes.orderBy("n").offset(offset).limit(limit).select("code")


def failure_kind(error: Column, rows: Column, success: Column) -> Column:
    """empty_data (a success without rows), network, parse or unknown by words of an error; blank without one."""
    e = F.lower(F.coalesce(error, F.lit("")))
    return (
        F.when(success & (rows == 0), "empty_data")
        .when(e == "", "")
        .when(e.rlike("timeout|timed out|connection|ssl|urlopen|network|refused|eof"), "network")
        .when(e.rlike("json|parse|decode|keyerror|valueerror"), "parse")
        .otherwise("unknown")
    )
