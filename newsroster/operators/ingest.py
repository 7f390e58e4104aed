"""Landed attempts to result rows: classification, retries, partial results, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..sources.payloads import is_meta
from ..schema import RAW_COLUMNS
from .clean import first_per_key
from .planning import MAX_RESULTS, META_PAGES, PAGE_SIZE

# Words that make a refused call (403) a quota matter.
QUOTA_WORDS = ["quota", "ratelimitexceeded", "dailylimitexceeded", "userratelimitexceeded"]
TRIES = 3  # calls made for a page before it counts as failed, by default


def attempt_outcome(
    status: Column, message: Column, body: Column, bad_body: Column, meta: Column,
) -> Column:
    """``quota``, ``failure`` or ``ok`` of one attempt.

    Too-many-requests is quota for both dialects; a refusal is quota only in the search dialect
    and only if it says so.
    """
    said = F.lower(F.concat(F.coalesce(message, F.lit("")), F.coalesce(body, F.lit(""))))
    refused = ~meta & (status == 403) & said.rlike("|".join(QUOTA_WORDS))
    ok = F.when(meta, status == 200).otherwise(status.between(200, 299))
    return (
        F.when(status == 429, F.lit("quota"))
        .when(refused, F.lit("quota"))
        .when(F.coalesce(ok, F.lit(False)) & ~bad_body, F.lit("ok"))
        .otherwise(F.lit("failure")))


def classify_attempts(landed: DataFrame) -> DataFrame:
    """Add ``outcome`` to attempts (provider, status, message, body, bad_body)."""
    return landed.withColumn("outcome", attempt_outcome(
        F.col("status"), F.col("message"), F.col("body"), F.col("bad_body"),
        is_meta(F.col("provider"))))


def page_outcome(attempts: DataFrame, carry: list[str] = (), tries: int = TRIES) -> DataFrame:
    """One row per (query, page): what its latest run found out.

    The first success or quota stop of that run counts, whatever its try; without one the page is
    a ``failure`` once ``tries`` calls have landed and ``open`` until then. The outcome does not
    depend on the order of rows. A plain aggregation, combined before the shuffle, however often
    a page was tried.
    """
    run = F.coalesce("run", F.lit(0))
    late = F.when(F.col("outcome").isin("ok", "quota"), 0).otherwise(1)
    best = F.min_by(F.struct("outcome", "try_no", *carry),
                    F.struct((-run).alias("run"), late.alias("late"), "try_no", "outcome"))
    last = F.max(F.struct(run.alias("run"), "try_no"))["try_no"]
    return (
        attempts.groupBy("query", "page").agg(best.alias("best"), last.alias("last_try"))
        .select("query", "page", "best.*", "last_try")
        .withColumn("outcome", F.when(
            (F.col("outcome") == "failure") & (F.col("last_try") < tries), F.lit("open"))
            .otherwise(F.col("outcome")))
        .drop("last_try"))


def stop_reason(pages: DataFrame) -> DataFrame:
    """Add ``n_items`` and why each page ends its query's paging, if it does.

    Needs ``outcome``, ``items`` and ``provider``. An empty list ends paging in the meta dialect
    only, a missing one in both; a short page never does.
    """
    meta = is_meta(F.col("provider"))
    empty = F.col("items").isNull() | (meta & (F.size("items") == 0))
    linked = F.filter("items", lambda item: item["link"] != "")
    counted = F.when(meta, F.size(linked)).otherwise(F.size("items"))
    return (
        pages
        .withColumn("stop", F.when(F.col("outcome") != "ok", F.col("outcome"))
                    .when(empty, F.lit("empty")))
        .withColumn("n_items", F.when(F.col("items").isNull(), 0).otherwise(counted)))


def partial_results(
    pages: DataFrame, max_results: int | None = None, meta_pages: int = META_PAGES,
) -> DataFrame:
    """Pages up to the first stop of their query, with ``usable`` and the query's ``status``.

    Input: one row per (query, page) with ``items``, ``n_items``, ``stop`` and ``provider``. Pages
    count as far as they follow each other from 1 on, until ``max_results`` items are there (None:
    all); the meta dialect counts different links.
    Status is ``quota`` (what the query found in this run is discarded), ``failed`` (stopped by a
    failure before anything was found), ``done`` (an empty page, a failure after results, the
    last page of the plan, or enough items) or ``open``: more pages are to come. The plan has as
    many pages as ``max_results`` takes, and ``meta_pages`` in the meta dialect. The stopping
    page itself stays, not usable.
    """
    planned = F.lit(None).cast("int") if max_results is None else F.lit(-(-max_results // PAGE_SIZE))
    meta = is_meta(F.col("provider"))
    last = F.when(meta, meta_pages).otherwise(planned)
    links = F.when(meta, F.filter(
        F.transform("items", lambda item: item["link"]), lambda link: link != ""))

    def items_in(window) -> Column:
        different = F.size(F.array_distinct(F.flatten(F.collect_list("__links").over(window))))
        return F.when(meta, different).otherwise(F.coalesce(F.sum("n_items").over(window), F.lit(0)))

    enough = F.lit(None).cast("long") if max_results is None else F.lit(max_results)
    run = Window.partitionBy("query").orderBy("page")
    before = run.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("query")
    reached = F.coalesce(items_in(whole) >= enough, F.lit(False))
    status = (
        F.when(F.bool_or(F.coalesce(F.col("stop") == "quota", F.lit(False))).over(whole), "quota")
        .when(F.bool_or(F.coalesce(
            (F.col("stop") == "failure") & (F.col("found") == 0), F.lit(False))).over(whole), "failed")
        .when(reached | F.bool_or(F.coalesce(F.col("stop").isin("empty", "failure"), F.lit(False))
                                  | F.coalesce(F.col("stop").isNull() & (F.col("page") == last), F.lit(False))
                                  ).over(whole), "done")
        .otherwise("open"))
    return (
        pages.where((F.col("page") >= 1) & F.coalesce(F.col("page") <= last, F.lit(True)))
        .withColumn("__links", links).withColumn("place", F.row_number().over(run))
        .withColumn("found", items_in(before))
        .withColumn("stops", F.count("stop").over(before))
        .where((F.col("stops") == 0) & (F.col("place") == F.col("page"))
               & F.coalesce(F.col("found") < enough, F.lit(True)))
        .withColumn("status", status)
        .withColumn("usable", F.col("stop").isNull() & (F.col("status") == "done"))
        .drop("found", "stops", "place", "__links"))


def query_status(kept: DataFrame) -> DataFrame:
    """One row per query of ``partial_results``: status and number of items kept."""
    return kept.groupBy("query").agg(
        F.first("status").alias("status"),
        F.coalesce(F.sum(F.when(F.col("usable"), F.col("n_items"))), F.lit(0)).alias("n_items"))


def cap_per_query(items: DataFrame, max_results: int = MAX_RESULTS) -> DataFrame:
    """The first ``max_results`` items of each query in page order."""
    window = Window.partitionBy("query").orderBy("page", "pos")
    return (
        items.withColumn("__rn", F.row_number().over(window))
        .where(F.col("__rn") <= max_results).drop("__rn"))


def unique_links_capped(items: DataFrame, max_results: int = MAX_RESULTS) -> DataFrame:
    """Non-empty links, first one per query wins, then the cap.

    Items: (query, page, pos, link, ...). Both ranks are cut before the shuffle.
    """
    linked = items.where("link IS NOT NULL AND link <> ''")
    unique = first_per_key(linked, ["query", "link"], [F.col("page"), F.col("pos")])
    return cap_per_query(unique, max_results)


def item_date(item: Column) -> Column:
    """Publication time of the first metatag map, if any."""
    return F.try_element_at(
        F.get(item["pagemap"]["metatags"], F.lit(0)), F.lit("article:published_time"))


def item_row(person: Column, item: Column) -> list[Column]:
    """Raw export columns of one item, '' for what is missing."""
    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    values = [person, text(item["title"]), text(item_date(item)), text(item["displayLink"]),
              text(item["link"])]
    return [value.alias(name) for value, name in zip(values, RAW_COLUMNS)]


def flatten_items(queries: DataFrame, items: DataFrame) -> DataFrame:
    """Raw rows of flat items (query, page, pos, item) plus one placeholder per empty query.

    Items are projected where they lie. Only the distinct queries that have some meet the query
    list, so a query with a third of all items costs no more than any other.
    """
    rows = items.select("query", "page", "pos", *item_row(F.col("query"), F.col("item")))
    found = items.select("query").distinct()
    missing = queries.select("query").join(found, "query", "left_anti")
    empty = [F.lit("").alias(name) for name in RAW_COLUMNS[1:]]
    placeholders = missing.select(
        "query", F.lit(0).alias("page"), F.lit(0).cast("long").alias("pos"),
        F.col("query").alias("Person"), *empty)
    return rows.unionByName(placeholders)


def items_by_query(items: DataFrame, max_results: int = MAX_RESULTS) -> DataFrame:
    """(query, items) lists of the first ``max_results`` items in page order. The limit comes
    before the lists, so that each fits a row."""
    items = cap_per_query(items, max_results)

    def compare(a: Column, b: Column) -> Column:
        later = (a["page"] > b["page"]) | ((a["page"] == b["page"]) & (a["pos"] > b["pos"]))
        return F.when(later, 1).otherwise(-1)

    placed = F.collect_list(F.struct("page", "pos", "item"))
    return (
        items.groupBy("query").agg(F.array_sort(placed, compare).alias("placed"))
        .select("query", F.transform("placed", lambda p: p["item"]).alias("items")))


def flatten_completed(completed: DataFrame) -> DataFrame:
    """Raw rows of stored lists (query, query_ord, items); an empty list keeps one placeholder."""
    return (
        completed.select("query", "query_ord", F.posexplode_outer("items").alias("pos", "item"))
        .select("query_ord", F.coalesce("pos", F.lit(0)).alias("pos"),
                *item_row(F.col("query"), F.col("item"))))


def links_only(items: DataFrame) -> DataFrame:
    return items.where(F.col("item.link").isNotNull()).select(
        *[c for c in items.columns if c != "item"], F.col("item.link").alias("link"))


def results_per_query(queries: DataFrame, items: DataFrame) -> DataFrame:
    """Result count of every query, zero included; items are counted before the join."""
    counts = items.groupBy("query").agg(F.count(F.lit(1)).alias("n_results"))
    return queries.join(counts, "query", "left").withColumn(
        "n_results", F.coalesce("n_results", F.lit(0)))
