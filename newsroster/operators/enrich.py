"""Missing dates and texts filled from fetched pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import html
from .clean import first_per_key

TEXT = "Title text"


def cut_text(text: Column, limit: int | None) -> Column:
    """The text, or its first ``limit`` characters if the caller sets a limit."""
    return text if limit is None else F.left(text, F.lit(limit))


BLOOM_HASHES = 3
BLOOM_MAX_BITS = 1 << 26  # 2^20 words of 64 bits, the most that is broadcast


def wanted_pages(pages: DataFrame, links: DataFrame, link: str = "Link") -> DataFrame:
    """Pages whose url may be one of ``links``: a semi-join reduction by a Bloom filter.

    The filter has about ten bits per wanted link (at least 2^10, at most ``BLOOM_MAX_BITS``) and
    three hashes; it is built by one aggregation into 64-bit words and joined to the page scan by
    word, broadcast, so pages are dropped in their scan stage and their html is neither parsed nor
    shuffled. Wanted pages always pass; a few others may (about 2 % at ten bits a link, more beyond
    the largest filter), which only costs their parsing: the exact join by link follows.
    """
    wanted = links.select(F.col(f"`{link}`").alias("__l")).where("__l IS NOT NULL AND __l <> ''")
    count = max(wanted.count(), 1)
    bits = 1 << max(10, min((count * 10 - 1).bit_length(), BLOOM_MAX_BITS.bit_length() - 1))
    spots = [F.pmod(F.xxhash64(F.lit(i), F.col("__l")), F.lit(bits)) for i in range(BLOOM_HASHES)]
    words = wanted.select(F.explode(F.array(*spots)).alias("pos")).groupBy(
        F.shiftright("pos", 6).alias("__w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(pos % 64 AS INT))")).alias("__bits"))
    kept = pages
    for i in range(BLOOM_HASHES):
        spot = F.pmod(F.xxhash64(F.lit(i), F.col("url")), F.lit(bits))
        probe = F.broadcast(words.select(F.col("__w").alias(f"__w{i}"), F.col("__bits").alias(f"__b{i}")))
        kept = kept.withColumn(f"__s{i}", spot).join(probe, F.shiftright(f"__s{i}", 6) == F.col(f"__w{i}"))
        kept = kept.where(F.expr(f"(shiftright(__b{i}, CAST(__s{i} % 64 AS INT)) & 1L) = 1L")).drop(
            f"__s{i}", f"__w{i}", f"__b{i}")
    return kept


def page_facts(pages: DataFrame, text_limit: int | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """One row per URL, first fetched wins: article, page_text and page_date instead of html.

    The html is reduced inside the scan stage, whatever the number of pages; it never reaches a
    shuffle. Texts are whole unless ``text_limit`` cuts them. With ``wanted`` (rows with ``Link``)
    pages that no row links are dropped before their html is parsed (``wanted_pages``); the facts
    of wanted pages are the same.
    """
    if wanted is not None:
        pages = wanted_pages(pages, wanted)
    facts = pages.withColumn("__visible", html.visible(F.col("html"))).select(
        "page_id", "url",
        cut_text(html.article_of(F.col("__visible")), text_limit).alias("article"),
        cut_text(html.text_of(F.col("__visible")), text_limit).alias("page_text"),
        html.publish_date(F.col("html"), F.col("url")).alias("page_date"))
    return first_per_key(facts, ["url"], [F.col("page_id")]).drop("page_id")


def merge_text(article: Column, existing: Column, page_text: Column,
               text_limit: int | None = None) -> Column:
    """Article text overwrites what is there; the whole page only fills a gap."""
    return F.coalesce(
        cut_text(F.nullif(article, F.lit("")), text_limit), existing,
        cut_text(page_text, text_limit))


def cut_date(df: DataFrame) -> DataFrame:
    """First ten characters of the date of rows with a link."""
    linked = F.coalesce(F.col("Link") != "", F.lit(False))
    return df.withColumn(
        "Date", F.when(linked, F.left("Date", F.lit(10))).otherwise(F.col("Date")))


def fill_blanks(mentions: DataFrame, facts: DataFrame, all_linked: bool = False) -> DataFrame:
    """Fill ``Date`` and ``Title text`` from ``page_facts`` by link; column order is kept.

    Rows without a link stay as they are. They get a key of their own each, so that many of them
    do not meet in one task. ``all_linked`` promises there are none: then the join key is the
    link itself and a partitioning by link is used again.
    """
    if TEXT not in mentions.columns:
        mentions = mentions.withColumn(TEXT, F.lit(None).cast("string"))
    columns = mentions.columns
    key = F.col("Link")
    if not all_linked:
        own = F.concat(F.lit("no link "), F.xxhash64("ord"))
        key = F.coalesce(F.nullif(key, F.lit("")), own)
    joined = mentions.withColumn("__key", key).join(
        facts.where("url <> ''"), F.col("__key") == F.col("url"), "left")
    filled = (
        joined
        .withColumn("Date", F.coalesce("Date", "page_date"))
        .withColumn(TEXT, merge_text(F.col("article"), F.col(f"`{TEXT}`"), F.col("page_text"))))
    return cut_date(filled).select(*[F.col(f"`{c}`") for c in columns])
