"""Writers, each checked by reading back what it wrote."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators.ingest import item_row
from ..operators.log_rows import log_batches
from ..operators.ordering import order_by, sort_rows, with_position
from ..plans.process import without_order
from ..plans.publish import dashboard_links
from ..session import scratch_path
from ..sinks import dashboard, files
from ..sources.files import read_mentions
from .ingest import flat_items
from .landed import Landed, oracle

AT = datetime(2024, 6, 30, 12, 5)


def save_csv(spark, folder):
    """The raw export of all items, written and scanned again."""
    items = flat_items(Landed(spark, folder))
    rows = items.select(*item_row(F.col("query"), F.col("item")))
    path = scratch_path(spark, "save_csv")
    files.write_csv(rows, path)
    return without_order(read_mentions(spark, path))


def first_query_links(spark, folder):
    """Links of the first query, one per line; ``n_links`` is what the writer reported."""
    path = scratch_path(spark, "links")
    written = files.write_links(files.first_query_items(flat_items(Landed(spark, folder))), path)
    return spark.read.text(path).select(
        F.col("value").alias("link"), F.lit(written).cast("long").alias("n_links"))


def sorted_csv(spark, folder):
    """A globally sorted export; the order of its lines survives the round trip."""
    rows = sort_rows(Landed(spark, folder).mentions, ["Source", "Date"], [True, False])
    path = scratch_path(spark, "sorted_csv")
    files.write_csv(without_order(rows), path)
    return without_order(with_position(read_mentions(spark, path), order_by(["ord"], tie=None)))


def with_verified(spark, folder):
    return files.with_verified(Landed(spark, folder).mentions)


def append_results(spark, folder):
    """Two appends to the result table."""
    rows = Landed(spark, folder).mentions
    path = scratch_path(spark, "results")
    first = files.append_results(rows, path)
    second = files.append_results(files.with_verified(rows), path)
    return spark.read.parquet(path).groupBy("Verified", "Person").agg(
        F.count(F.lit(1)).alias("rows")).withColumn("written", F.lit(first + second).cast("long"))


def upsert_kv(spark, folder):
    board = Landed(spark, folder).board
    return dashboard.upsert(board, dashboard_links(spark, "raw.csv", "sorted.csv"))


def logs(spark, folder):
    return log_batches(Landed(spark, folder).log_records, 25)


def snapshot_export(spark, folder):
    rows = Landed(spark, folder).nation.join(
        Landed(spark, folder).customer, F.col("n_nationkey") == F.col("c_nationkey"))
    path = files.write_snapshot(
        rows.select(F.col("c_name").alias("Person"), F.col("n_name").alias("Title"),
                    F.lit("").alias("Date"), F.col("c_mktsegment").alias("Source"),
                    F.lit(None).cast("string").alias("Link")),
        scratch_path(spark, "snapshots"), "search_results.csv", AT)
    return without_order(read_mentions(spark, path)).withColumn(
        "snapshot", F.lit(path.rsplit("/", 1)[1]))


QUERIES = {
    "save_csv": save_csv, "first_query_links": first_query_links, "sorted_csv": sorted_csv,
    "with_verified": with_verified, "append_results": append_results, "upsert_kv": upsert_kv,
    "log_batches": logs, "snapshot_export": snapshot_export,
}

ORACLE = {
    "save_csv": oracle("""
        SELECT query AS Person, nullif(title, '') AS Title, published AS Date, nullif(host, '') AS Source,
               nullif(link, '') AS Link FROM {items}"""),
    "first_query_links": oracle("""
        SELECT link, count(*) OVER () AS n_links FROM {items}
        WHERE query_ord = (SELECT min(query_ord) FROM {items})"""),
    "sorted_csv": oracle("""
        SELECT Person, Title, Date, Source, Link,
               row_number() OVER (ORDER BY Source, Date DESC NULLS LAST, ord) AS rank FROM {mentions}"""),
    "with_verified": oracle("SELECT false AS Verified, * FROM {mentions}"),
    "append_results": oracle("""
        SELECT false AS Verified, Person, 2 * count(*) AS rows,
               CAST(2 * sum(count(*)) OVER () AS BIGINT) AS written FROM {mentions} GROUP BY Person"""),
    "upsert_kv": oracle("""
        SELECT ord, key, CASE WHEN ord = (SELECT max(ord) FROM {board}
                                          WHERE trim(key) = 'raw_csv_link') THEN 'raw.csv'
                              ELSE value END AS value FROM {board}
        UNION ALL SELECT max(ord) + 2, 'sorted_csv_link', 'sorted.csv' FROM {board}"""),
    "log_batches": oracle("""
        SELECT event_id, level, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, message,
               (n - 1) // 25 AS batch,
               row_number() OVER (PARTITION BY (n - 1) // 25 ORDER BY n DESC) AS position
        FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM {log_records}
              WHERE NOT (starts_with(logger_name, 'google.') OR starts_with(logger_name, 'urllib3')
                         OR starts_with(logger_name, 'gspread')))"""),
    "snapshot_export": """
        SELECT c_name AS Person, n_name AS Title, CAST(NULL AS VARCHAR) AS Date,
               c_mktsegment AS Source, CAST(NULL AS VARCHAR) AS Link,
               '2024-06-30_12-05_search_results.csv' AS snapshot
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
}
