"""From roster to search plan: queries, dates, pages and the day's budget."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import compact_date, iso_day
from ..functions.text import strip, strip_chars, unquote
from .ordering import order_by, with_running_total

# Limits of the search interface, used as defaults.
MAX_RESULTS = 100
PAGE_SIZE = 10
META_PAGES = 10
EARLIEST = "19700101"


def expand_roster(
    roster: DataFrame, optional: bool = False, spellings: bool = False,
) -> DataFrame:
    """Distinct search queries of a roster (ord, Priority, Member ENG, ...).

    ``query_ord`` is where a query was first seen: roster row, then English name, Ukrainian name
    and spellings in their listed order.
    """
    def cell(name: str) -> Column:
        return strip(F.coalesce(F.col(f"`{name}`"), F.lit("")))

    rows = roster
    if not optional:
        rows = rows.where(F.lower(cell("Priority")) != "optional")
    names = F.array(cell("Member ENG"), cell("Member UKR"))
    if spellings:
        parts = F.transform(F.split(cell("Pronounciations"), ",", -1), strip)
        names = F.concat(names, F.transform(parts, lambda p: strip_chars(p, ',"')))
    return (
        rows.select("ord", F.posexplode(names).alias("pos", "query")).where("query <> ''")
        .groupBy("query").agg(F.min(F.struct("ord", "pos")).alias("query_ord"))
        .select("query", F.col("query_ord.ord").alias("ord"), F.col("query_ord.pos").alias("pos")))


def decode_queries(queries: DataFrame) -> DataFrame:
    return queries.withColumn("decoded", unquote(F.col("query")))


def sort_parameter(by_date: Column, start: Column, end: Column, today: date) -> Column:
    """Range ``date:r:from:to`` if either bound is a valid date, else ``date`` or null."""
    first, last = compact_date(start), compact_date(end)
    ranged = F.concat(
        F.lit("date:r:"), F.coalesce(first, F.lit(EARLIEST)), F.lit(":"),
        F.coalesce(last, F.lit(today.strftime("%Y%m%d"))))
    return F.when(first.isNotNull() | last.isNotNull(), ranged).when(by_date, F.lit("date"))


def in_date_range(df: DataFrame, column: str, start: str | None, end: str | None,
                  today: date) -> DataFrame:
    """Rows whose date text falls into the inclusive window; no bounds keep everything."""
    first, last = compact_date(F.lit(start)), compact_date(F.lit(end))  # folded to constants
    day = F.replace(iso_day(F.col(f"`{column}`")), F.lit("-"), F.lit(""))
    inside = day.between(
        F.coalesce(first, F.lit(EARLIEST)), F.coalesce(last, F.lit(today.strftime("%Y%m%d"))))
    return df.where((first.isNull() & last.isNull()) | inside)


def plan_pages(
    queries: DataFrame, max_results: Column | int = MAX_RESULTS,
    interface_limit: int | None = MAX_RESULTS,
) -> DataFrame:
    """One row per page to ask for: start offset and number of results.

    ``interface_limit``: results that the interface gives for one query at most, None if all.
    """
    wanted = _wanted(F.lit(max_results) if isinstance(max_results, int) else max_results,
                     interface_limit)
    return (
        queries.withColumn("__wanted", wanted).where("__wanted > 0")
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("__wanted"), F.lit(PAGE_SIZE))))
        .withColumn("page", F.expr(f"cast((start - 1) div {PAGE_SIZE} + 1 as int)"))
        .withColumn("num", F.least(F.lit(PAGE_SIZE), F.col("__wanted") - F.col("start") + 1))
        .drop("__wanted"))


def _wanted(max_results: Column, limit: int | None) -> Column:
    wanted = max_results.cast("int")
    return wanted if limit is None else F.least(wanted, F.lit(limit))


def page_cost(max_results: Column, interface_limit: int | None = MAX_RESULTS) -> Column:
    """Calls one query takes."""
    wanted = F.greatest(_wanted(max_results, interface_limit), F.lit(0))
    return F.ceil(wanted / PAGE_SIZE).cast("int")


def within_budget(pending: DataFrame, keys: list[str], cost: str, budget: int) -> DataFrame:
    """The leading queries, in the order of ``keys``, that the call budget covers in full."""
    summed = with_running_total(pending, order_by(keys, tie=None), cost, "calls_so_far")
    return summed.where(F.col("calls_so_far") <= budget)
