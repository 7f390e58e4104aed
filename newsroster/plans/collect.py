"""Collect: roster and landed attempts to completed queries and raw rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from ..operators import ingest, planning, state
from ..session import cut_lineage
from ..sources.payloads import is_meta, with_items


@dataclass(frozen=True)
class Collected:
    queries: DataFrame
    completed: DataFrame
    failures: DataFrame
    #: with a ledger: the queries finished by this run, and the ledger of failed runs after it
    done: DataFrame | None = None
    ledger: DataFrame | None = None
    #: with a budget: the next run's work list, one row per page to ask for
    plan: DataFrame | None = None

    @property
    def raw(self) -> DataFrame:
        """Raw export rows of everything completed so far, queries no longer asked included."""
        places = self.queries.select("query", F.struct("ord", "pos").alias("query_ord"))
        return raw_rows(self.completed.join(places, "query", "left"))

    @property
    def first_query_items(self) -> DataFrame:
        """Items of the first query of the roster, one per row; none while it is pending."""
        places = self.queries.select("query", F.struct("ord", "pos").alias("query_ord"))
        first = places.agg(F.min("query_ord").alias("query_ord")).join(places, "query_ord")
        return self.completed.join(first.select("query"), "query", "left_semi").select(
            "query", F.posexplode("items").alias("pos", "item"))

    @property
    def status(self) -> DataFrame:
        return state.run_status(self.queries, self.completed)


def query_pages(
    landed: DataFrame, max_results: int | None = planning.MAX_RESULTS,
    tries: int = ingest.TRIES, meta_pages: int = planning.META_PAGES, with_run: bool = False,
) -> DataFrame:
    """Landed attempts to the pages of each query up to its first stop; ``with_run`` keeps the run
    of the attempt that decided each page."""
    attempts = ingest.classify_attempts(with_items(landed))
    pages = ingest.page_outcome(attempts, ["provider", "items", *(["run"] if with_run else [])], tries)
    return ingest.partial_results(ingest.stop_reason(pages), max_results, meta_pages)


def query_outcomes(pages: DataFrame, max_results: int | None) -> DataFrame:
    """One row per query: status and its capped items in page order.

    The items of a query are at most ``max_results`` and what its last page adds, or all that the
    interface gives for it (None), and fit one row. The meta dialect drops results
    without a link and repeated links. Grouping follows the window of ``query_pages`` by the same
    key and needs no shuffle of its own.
    """
    def by_page(a: Column, b: Column) -> Column:
        return F.when(a["page"] > b["page"], 1).otherwise(-1)

    def unique(hits: Column) -> Column:
        both = F.struct(hits.alias("hits"), F.transform(hits, lambda h: h["link"]).alias("links"))
        return let(both, lambda b: F.filter(
            b["hits"], lambda h, i: (h["link"] != "")
            & (F.array_position(b["links"], h["link"]) == i + 1)))

    lists = F.collect_list(F.when(F.col("usable"), F.struct("page", "items")))
    failed_run = [F.max(F.when(F.col("stop") == "failure", F.coalesce("run", F.lit(0)))).alias("failed_run")] \
        if "run" in pages.columns else []
    grouped = pages.groupBy("query").agg(
        F.max("status").alias("status"), F.bool_or(is_meta(F.col("provider"))).alias("meta"),
        F.array_sort(lists, by_page).alias("lists"), *failed_run)
    hits = F.flatten(F.transform("lists", lambda p: p["items"]))
    kept = F.when(F.col("meta"), unique(F.col("hits"))).otherwise(F.col("hits"))
    if max_results is not None:
        kept = F.slice(kept, F.lit(1), F.lit(max_results))
    runs = ["failed_run"] if failed_run else []
    return (
        grouped.select("query", "status", "meta", hits.alias("hits"), *runs)
        .select("query", "status", kept.alias("items"), *runs))


def collect(
    roster: DataFrame, landed: DataFrame, completed: DataFrame, failures: DataFrame, *,
    optional: bool = False, spellings: bool = False,
    max_results: int | None = planning.MAX_RESULTS, give_up_after: int = state.GIVE_UP_AFTER,
    tries: int = ingest.TRIES, meta_pages: int = planning.META_PAGES,
    ledger: DataFrame | None = None, budget: int | None = None,
) -> Collected:
    """One run over the attempts that landed for pending queries.

    With a ``ledger`` (query, run) of failed runs, ``failures`` is ignored: a failed query adds the
    run of the attempts that failed its page, and its count is the number of distinct runs. A failure
    that a later run sees again in the same attempts (because it collects with the query's whole
    history) is then the same entry and is not counted twice.

    With a ``budget`` of calls, ``plan`` is the work list of the next run (see ``next_pages``).

    A failed query counts one failure and is retried by a later run until it is given up with an
    empty result. Quota leaves a query pending, and so does a query whose pages have not all
    landed yet: hand its earlier pages in again with the later ones. If no results are wanted
    (0), every query is done with an empty result.

    What a run found is one row per query, pinned on shared storage: bodies are read once,
    however many of the resulting tables are used.
    """
    queries = planning.expand_roster(roster, optional, spellings)
    pending = state.pending_queries(queries, completed)
    asked = landed.join(pending.select("query"), "query", "left_semi")
    nothing = F.array().cast(completed.schema["items"].dataType)
    with_run = ledger is not None
    if max_results == 0:
        outcomes = pending.select("query", F.lit("done").alias("status"), nothing.alias("items"))
        if with_run:
            outcomes = outcomes.withColumn("failed_run", F.lit(None).cast("int"))
    else:
        pages = query_pages(asked, max_results, tries, meta_pages, with_run)
        outcomes = query_outcomes(pages, max_results)
    failed = F.coalesce(F.col("status") == "failed", F.lit(False))
    if with_run:  # two tables come from the outcomes: the ledger and, through its counts, the run
        outcomes = cut_lineage(outcomes)
        ledger = cut_lineage(ledger.select("query", F.col("run").cast("int")).unionByName(
            outcomes.where(failed).select("query", F.coalesce("failed_run", F.lit(0)).cast("int").alias("run"))
        ).distinct())
        failures = ledger.groupBy("query").agg(F.count(F.lit(1)).cast("int").alias("n"))
        outcomes = outcomes.drop("failed_run")
    run = outcomes.join(
        failures.withColumnRenamed("n", "before"), "query", "full")
    counted = cut_lineage(run.withColumn("n", F.coalesce("before", F.lit(0)) + (
        F.lit(0) if with_run else failed.cast("int"))))
    given_up = failed & (F.col("n") >= give_up_after)
    finished = given_up | F.coalesce(F.col("status") == "done", F.lit(False))
    done = counted.where(finished).select(
        "query", F.when(given_up, nothing).otherwise(F.col("items")).alias("items"))
    # Pending and completed queries are disjoint, so the upsert is a union.
    completed = completed.select("query", "items").unionByName(done)
    failures = counted.where(~finished & (F.col("n") > 0)).select("query", "n")
    plan = None
    if budget is not None and max_results:  # with no results wanted (0) nothing is left to ask
        plan = next_pages(state.pending_queries(queries, completed), pages, max_results, meta_pages, budget)
    return Collected(queries, completed, failures, done if with_run else None, ledger, plan)


def next_pages(
    pending: DataFrame, pages: DataFrame, max_results: int, meta_pages: int, budget: int,
) -> DataFrame:
    """Pages the next run asks for: (query, ord, pos, page, start, num).

    A pending query goes on at its first page without results in hand (a failed, open, quota or
    missing page is asked again; the pages before it are kept in the landed attempts) up to the
    last page of the plan (``meta_pages`` in the meta dialect). Queries take their turn in roster
    order, and the leading ones whose calls all fit the ``budget`` are in the plan. The running
    sum of calls is a distributed running total, not a single task.
    """
    planned = -(-max_results // planning.PAGE_SIZE)
    read = pages.groupBy("query").agg(
        (F.count(F.when(F.col("stop").isNull(), 1)) + 1).alias("next"),
        F.bool_or(is_meta(F.col("provider"))).alias("meta"))
    last = F.when(F.coalesce("meta", F.lit(False)), F.lit(meta_pages)).otherwise(F.lit(planned))
    todo = pending.join(read, "query", "left").select(
        "query", "ord", "pos", F.coalesce("next", F.lit(1)).alias("next"), last.alias("last"))
    todo = todo.withColumn("calls", F.greatest(F.col("last") - F.col("next") + 1, F.lit(0))).where("calls > 0")
    chosen = planning.within_budget(todo, ["ord", "pos"], "calls", budget)
    return chosen.select(
        "query", "ord", "pos", F.explode(F.sequence("next", "last")).alias("page")
    ).select("query", "ord", "pos", F.col("page").cast("int").alias("page"),
             ((F.col("page") - 1) * planning.PAGE_SIZE + 1).cast("int").alias("start"),
             F.least(F.lit(planning.PAGE_SIZE),
                     F.lit(max_results) - (F.col("page") - 1) * planning.PAGE_SIZE).cast("int").alias("num"))


def raw_rows(completed: DataFrame) -> DataFrame:
    """Raw export rows with ``ord``: query place in the roster, then item place."""
    flat = ingest.flatten_completed(completed)
    return flat.select(
        F.struct(F.coalesce("query_ord.ord", F.lit((1 << 63) - 1)).alias("ord"),
                 F.coalesce("query_ord.pos", F.lit(0)).alias("name"),
                 F.col("Person").alias("query"), F.col("pos").alias("pos")).alias("ord"),
        *[F.col(c) for c in flat.columns if c not in ("query_ord", "pos")])
