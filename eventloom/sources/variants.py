"""Nested search results of changing shape, parsed once into VARIANT values and picked apart by paths with fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def _text(v: Column, path: str) -> Column:
    """The value at a path as trimmed text; empty if it isn't there."""
    return F.trim(F.coalesce(F.try_variant_get(v, path, "string"), F.lit("")))


def _filled(*texts: Column) -> Column:
    """The first text that isn't empty, else the empty one."""
    return F.coalesce(*(F.nullif(t, F.lit("")) for t in texts), F.lit(""))


def content_of(item: Column) -> Column:
    """An item's body: the first filled element named content of its extension (an object, or an object in a string), else its plain content; without tags."""
    extension = F.try_parse_json(F.try_variant_get(item, "$.infoextends", "string"))
    elements = F.coalesce(F.try_variant_get(extension, "$.elementList", "array<variant>"), F.array().cast("array<variant>"))
    named = F.filter(elements, lambda x: F.lower(_text(x, "$.fieldName")) == "content")
    texts = F.filter(F.transform(named, lambda x: T.without_tags(_text(x, "$.fieldValue"))), lambda t: t != "")
    return _filled(F.get(texts, F.lit(0)), T.without_tags(_text(item, "$.infocontent")))


def search_items(pages: DataFrame, payload: str, results: str = "$.data.searchResult.dataResults", inner: str = "$.groupData[0].data", base: str = "") -> DataFrame:
    """(title, publish_time, content, url) of all items of pages of search results, beside the pages' other columns.

    Times come from two text fields or, without them, from milliseconds since
    1970.  Malformed pages, items of other types, and items without title or body
    give no row; addresses from the root get ``base`` in front.
    """
    parsed = pages.withColumn("_page", F.try_parse_json(payload)).drop(payload)
    items = parsed.withColumn("_item", F.explode(F.try_variant_get("_page", results, "array<variant>")))
    data = items.withColumn("_data", F.coalesce(F.try_variant_get("_item", inner, "variant"), F.col("_item")))
    v, url = F.col("_data"), _text(F.col("_data"), "$.url")
    epoch = F.date_format(F.timestamp_millis(F.try_variant_get(v, "$.createdate", "bigint")), "yyyy-MM-dd HH:mm:ss")
    out = data.select(
        *[c for c in pages.columns if c != payload], T.without_tags(_text(v, "$.title")).alias("title"), _filled(_text(v, "$.jsearch_date"), _text(v, "$.deploytime"), F.coalesce(epoch, F.lit(""))).alias("publish_time"),
        content_of(v).alias("content"), F.when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(url).alias("url"),
    )
    return out.filter("title <> '' AND content <> ''")
