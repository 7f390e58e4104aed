"""Search-result payloads in two dialects, read from the body column of landed attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..functions.urls import netloc
from ..schema import ITEM, META_ITEM

_CORRUPT = T.StructField("_corrupt_record", T.StringType())
_SEARCH = T.StructType([T.StructField("items", T.ArrayType(ITEM)), _CORRUPT])
_META = T.StructType([T.StructField("results", T.ArrayType(META_ITEM)), _CORRUPT])


def _parsed(body: Column, schema: T.StructType) -> Column:
    return F.from_json(
        body, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})


def is_meta(provider: Column) -> Column:
    """Provider setting, trimmed and lower-cased; anything else is the default provider."""
    return F.coalesce(F.lower(strip(provider)) == "searxng", F.lit(False))


def to_item(result: Column) -> Column:
    """Meta-search result in the shape of a search item; the date is nested only if present."""
    url = F.coalesce(result["url"], F.lit(""))
    published = result["publishedDate"]
    pagemap = F.struct(F.array(F.create_map(
        F.lit("article:published_time"), published)).alias("metatags"))
    return F.struct(
        F.coalesce(result["title"], F.lit("")).alias("title"), url.alias("link"),
        netloc(url).alias("displayLink"),
        F.when(published != "", pagemap).alias("pagemap")).cast(ITEM)


def with_items(landed: DataFrame) -> DataFrame:
    """Add ``items`` (null when the payload has none) and ``bad_body`` to mixed-dialect pages.

    The body is parsed once, with the schema of its provider.
    """
    meta = is_meta(F.col("provider"))
    return (
        landed
        .withColumn("__search", F.when(~meta, _parsed(F.col("body"), _SEARCH)))
        .withColumn("__meta", F.when(meta, _parsed(F.col("body"), _META)))
        .withColumn("items", F.when(meta, F.transform("__meta.results", to_item))
                    .otherwise(F.col("__search.items")))
        .withColumn("bad_body", F.coalesce(
            "__search._corrupt_record", "__meta._corrupt_record").isNotNull()
            | F.col("body").isNull() | (strip(F.col("body")) == ""))
        .drop("__search", "__meta"))


def explode_items(pages: DataFrame) -> DataFrame:
    """One row per item; pages without items give none."""
    kept = [c for c in pages.columns if c not in ("items", "body", "bad_body")]
    return pages.select(*kept, F.posexplode("items").alias("pos", "item"))
