"""Resume state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import state as S
from ..operators.ingest import unique_links_capped
from ..schema import ITEM
from ..session import scratch_path
from ..sinks.state_store import StateStore
from .landed import Landed, oracle


def stored(landed):
    """Completed queries from the stored view, one item each."""
    item = F.struct(
        F.col("title"), F.col("link"), F.lit(None).cast("string").alias("displayLink"),
        F.lit(None).cast(ITEM["pagemap"].dataType).alias("pagemap")).cast(ITEM)
    return landed.stored.select("query", F.array(item).alias("items"))


def names(landed):
    return landed.customer.select(F.col("c_name").alias("query"))


def _links(completed):
    return completed.select("query", F.array_join(
        F.transform("items", lambda item: item["link"]), " ").alias("links"))


def state_mark_done(spark, folder):
    """All found items become results; both tables after the upsert, told apart by ``part``."""
    landed = Landed(spark, folder)
    kept = unique_links_capped(landed.items, 100)  # the lists that a state holds are capped
    found = kept.groupBy("query").agg(F.sort_array(F.collect_list("link")).alias("links"))
    done = found.select("query", F.transform("links", lambda link: F.struct(
        F.lit(None).cast("string").alias("title"), link.alias("link"),
        F.lit(None).cast("string").alias("displayLink"),
        F.lit(None).cast(ITEM["pagemap"].dataType).alias("pagemap"))).cast(
            stored(landed).schema["items"].dataType).alias("items"))
    completed, failures = S.mark_done(stored(landed), landed.failure_counts, done)
    return _links(completed).select("query", F.lit("completed").alias("part"), "links",
                                    F.lit(None).cast("int").alias("n")).unionByName(
        failures.select("query", F.lit("failures").alias("part"),
                        F.lit(None).cast("string").alias("links"), "n"))


def state_failures(spark, folder):
    """Failed attempts of the log on top of the stored counts."""
    landed = Landed(spark, folder)
    return S.record_failures(landed.failure_counts, landed.attempts.where("status = 500"))


def give_up(spark, folder):
    landed = Landed(spark, folder)
    counts = S.record_failures(landed.failure_counts, landed.attempts.where("status = 500"))
    return S.give_up(counts)


def pending_queries(spark, folder):
    landed = Landed(spark, folder)
    return S.pending_queries(names(landed), stored(landed))


def state_results(spark, folder):
    landed = Landed(spark, folder)
    return _links(S.stored_results(names(landed), stored(landed)))


def run_status(spark, folder):
    landed = Landed(spark, folder)
    return S.run_status(names(landed), stored(landed))


def state_store(spark, folder):
    """Save, clear, save again: what a fresh load sees, with the version it came from."""
    landed = Landed(spark, folder)
    store = StateStore(spark, scratch_path(spark, "state"))
    store.save(stored(landed), landed.failure_counts)
    store.clear()
    store.save(stored(landed), landed.failure_counts)
    completed, failures = store.load()
    return _links(completed).join(failures, "query", "full").select(
        F.lit(store.version()).alias("version"), "query", "links", "n")


QUERIES = {
    "state_mark_done": state_mark_done, "state_failures": state_failures, "give_up": give_up,
    "pending_queries": pending_queries, "state_results": state_results, "run_status": run_status,
    "state_store": state_store,
}

_COUNTS = """
    SELECT query, CAST(sum(n) AS INT) AS n FROM (
        SELECT query, n FROM {failure_counts}
        UNION ALL SELECT query, 1 FROM {attempts} WHERE status = 500) GROUP BY query"""

ORACLE = {
    "state_mark_done": oracle("""
        SELECT query, 'completed' AS part, array_to_string(list_sort(list(link)), ' ') AS links,
               CAST(NULL AS INT) AS n FROM {kept} GROUP BY query
        UNION ALL SELECT query, 'completed', link, NULL FROM {stored}
        WHERE query NOT IN (SELECT query FROM {kept})
        UNION ALL SELECT query, 'failures', NULL, n FROM {failure_counts}
        WHERE query NOT IN (SELECT query FROM {kept})""", kept="""
        SELECT query, link FROM (
            SELECT *, row_number() OVER (PARTITION BY query ORDER BY page, pos) AS place
            FROM (SELECT *, row_number() OVER (PARTITION BY query, link ORDER BY page, pos) AS copy
                  FROM {items} WHERE link <> '') WHERE copy = 1)
        WHERE place <= 100"""),
    "state_failures": oracle(_COUNTS),
    "give_up": oracle(
        "SELECT query, n, CASE WHEN n >= 3 THEN 'give_up' ELSE 'retry' END AS decision FROM {counts}",
        counts=_COUNTS),
    "pending_queries": oracle("""
        SELECT c_name AS query FROM customer WHERE c_name NOT IN (SELECT query FROM {stored})"""),
    "state_results": oracle("""
        SELECT c_name AS query, coalesce(s.link, '') AS links
        FROM customer LEFT JOIN {stored} s ON s.query = c_name"""),
    "run_status": oracle("""
        SELECT count(s.query) AS done, count(*) - count(s.query) AS pending,
               count(*) = count(s.query) AS complete
        FROM customer LEFT JOIN {stored} s ON s.query = c_name"""),
    "state_store": oracle("""
        SELECT 3 AS version, coalesce(s.query, f.query) AS query,
               s.link AS links, f.n
        FROM {stored} s FULL JOIN {failure_counts} f ON f.query = s.query"""),
}
