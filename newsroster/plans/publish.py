"""Publish: raw output always, ranked output and dashboard once nothing is pending."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.state import is_complete
from ..session import cut_lineage
from ..sinks import dashboard, files
from ..sinks.state_store import StateStore
from ..sources.files import without_missing
from .collect import Collected
from .process import without_order

BOARD = "ord long, key string, value string"


def dashboard_links(spark: SparkSession, raw: str, ranked: str) -> DataFrame:
    return spark.createDataFrame(
        [(0, "raw_csv_link", raw), (1, "sorted_csv_link", ranked)], BOARD)


def publish(
    run: Collected, rank: Callable[[DataFrame], DataFrame], store: StateStore, root: str,
    at: datetime, board: DataFrame | None = None,
) -> dict:
    """Save the state, the raw rows and the first query's links; if nothing is pending also the
    ranked table.

    ``rank`` makes the ranked table of the raw mentions, which come from the saved state; exports
    are only written. The result table takes the ranked rows as run ``at`` (see
    ``files.append_results``), so a job stopped at any step and repeated with the same ``at`` leaves
    each run's rows in it once.
    Returns the written paths, whether the run was complete and the new dashboard table.
    """
    spark, root = store.spark, root.rstrip("/")
    store.save(run.completed, run.failures)
    saved = Collected(run.queries, *store.load())  # from here on the saved state is read
    raw = files.write_snapshot(
        without_order(saved.raw.orderBy("ord")), root, "search_results.csv", at)
    links = f"{root}/{files.snapshot_name('links.txt', at)}"
    files.write_links(saved.first_query_items, links)
    out = {"raw": raw, "links": links, "ranked": None, "board": board, "complete": False}
    if not is_complete(saved.queries, saved.completed):
        return out
    ranked = without_order(cut_lineage(rank(without_missing(saved.raw))))
    path = files.write_snapshot(ranked, root, "links_sorted.csv", at)
    # the job's time names the run: a repeated job replaces its rows instead of adding them again
    files.append_results(ranked, f"{root}/results", run_id=f"{at:%Y%m%d%H%M}")
    board = board if board is not None else spark.createDataFrame([], BOARD)
    board = dashboard.upsert(board, dashboard_links(spark, raw, path))
    store.clear()
    return out | {"ranked": path, "board": board, "complete": True}
