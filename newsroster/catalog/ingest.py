"""Landed attempts to result rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest as I
from ..plans.collect import query_pages
from ..schema import ITEM
from ..sources.payloads import is_meta, with_items
from .landed import Landed, oracle


# Limits of the runs here: two calls for a page, two pages, twenty results.
TRIES = 2
LIMITS = {"max_results": 20, "tries": TRIES, "meta_pages": 2}


def flat_items(landed):
    """The flat items with a search-shaped ``item`` column."""
    pagemap = F.when(F.col("published").isNotNull(), F.struct(F.array(F.create_map(
        F.lit("article:published_time"), F.col("published"))).alias("metatags")))
    item = F.struct(F.col("title"), F.col("link"), F.col("host").alias("displayLink"),
                    pagemap.alias("pagemap")).cast(ITEM)
    return landed.items.select("query", "query_ord", "page", "pos", item.alias("item"))


def classify_attempts(spark, folder):
    rows = I.classify_attempts(with_items(Landed(spark, folder).landed()))
    return rows.select("event_id", "query", "page", "try_no", "outcome")


def page_outcome(spark, folder):
    rows = I.classify_attempts(with_items(Landed(spark, folder).landed()))
    return I.page_outcome(rows, tries=TRIES)


def partial_results(spark, folder):
    pages = query_pages(Landed(spark, folder).landed(), **LIMITS)
    return pages.select("query", "page", "stop", "n_items", "status", "usable")


def query_status(spark, folder):
    return I.query_status(query_pages(Landed(spark, folder).landed(), **LIMITS))


def unique_links_capped(spark, folder):
    rows = Landed(spark, folder).items.select("query", "page", "pos", "link", "title")
    return I.unique_links_capped(rows, 30)


def item_date(spark, folder):
    return flat_items(Landed(spark, folder)).select(
        "query", "page", "pos", I.item_date(F.col("item")).alias("published"))


def flatten_items(spark, folder):
    """Raw rows of every roster name; names without hits keep one empty row."""
    landed = Landed(spark, folder)
    names = landed.customer.select(F.col("c_name").alias("query"))
    return I.flatten_items(names, flat_items(landed))


def query_results(spark, folder):
    """The mapping form: capped item lists per query, as their links."""
    return I.items_by_query(flat_items(Landed(spark, folder)), 100).select(
        "query", F.array_join(F.transform("items", lambda item: item["link"]), " ").alias("links"))


def links_only(spark, folder):
    return I.links_only(flat_items(Landed(spark, folder)))


def results_per_query(spark, folder):
    landed = Landed(spark, folder)
    names = landed.customer.select(F.col("c_name").alias("query"))
    return I.results_per_query(names, landed.items.select("query"))


QUERIES = {
    "classify_attempts": classify_attempts, "page_outcome": page_outcome,
    "partial_results": partial_results, "query_status": query_status,
    "unique_links_capped": unique_links_capped, "item_date": item_date,
    "flatten_items": flatten_items, "links_only": links_only,
    "results_per_query": results_per_query, "query_results": query_results,
}

# Expected outcomes, step by step.
CLASSIFIED = """
    SELECT a.*, provider = ' SearXNG ' AS meta,
           CASE WHEN status = 429 THEN 'quota'
                WHEN status = 403 AND provider <> ' SearXNG ' AND message ILIKE '%quota%' THEN 'quota'
                WHEN status = 200 AND body_kind <> 'junk' THEN 'ok' ELSE 'failure' END AS outcome,
           coalesce(i.n, 0) AS n_all, coalesce(i.linked, 0) AS n_linked
    FROM {attempts} a
    LEFT JOIN (SELECT event_id, count(*) AS n, count(*) FILTER (WHERE link <> '') AS linked
               FROM {attempt_items} GROUP BY event_id) i ON i.event_id = a.event_id"""
PAGES = """
    SELECT * EXCLUDE (outcome), CASE WHEN outcome = 'failure' AND last_try < 2 THEN 'open'
                                     ELSE outcome END AS outcome
    FROM (
        SELECT *, row_number() OVER (PARTITION BY query, page ORDER BY run DESC,
                      CASE WHEN outcome IN ('ok', 'quota') THEN 0 ELSE 1 END, try_no) AS rn,
               max(try_no) OVER (PARTITION BY query, page, run) AS last_try
        FROM {classified}) WHERE rn = 1"""
STOPS = """
    SELECT query, page, event_id, meta,
           CASE WHEN outcome <> 'ok' THEN outcome
                WHEN body_kind = 'missing' OR (meta AND n_all = 0) THEN 'empty' END AS stop,
           CAST(CASE WHEN outcome <> 'ok' OR body_kind = 'missing' THEN 0
                     WHEN meta THEN n_linked ELSE n_all END AS INT) AS n_items
    FROM {pages_tried}"""
# Pages without a gap before them, a stop before them, or twenty results before them (no query of
# the given data has that many, so that repeated links need not be told apart here).
ASKED = """
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY query ORDER BY page) AS place,
               coalesce(sum(n_items) OVER (PARTITION BY query ORDER BY page
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS found,
               count(stop) OVER (PARTITION BY query ORDER BY page
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stops
        FROM {stops} WHERE page <= 2)
    WHERE place = page AND stops = 0 AND found < 20"""
STATUS = """
    SELECT query,
           CASE WHEN count(*) FILTER (stop = 'quota') > 0 THEN 'quota'
                WHEN count(*) FILTER (stop = 'failure' AND found = 0) > 0 THEN 'failed'
                WHEN count(*) FILTER (stop IN ('empty', 'failure') OR (stop IS NULL AND page = 2)) > 0
                     OR sum(n_items) >= 20 THEN 'done' ELSE 'open' END AS status
    FROM {asked_pages} GROUP BY query"""
PARTIAL = """
    SELECT s.query, s.page, s.stop, s.n_items, t.status, s.event_id, s.meta,
           s.stop IS NULL AND t.status = 'done' AS usable
    FROM {asked_pages} s JOIN {status_of} t ON t.query = s.query"""
STEPS = {"classified": CLASSIFIED, "pages_tried": PAGES, "stops": STOPS,
         "asked_pages": ASKED, "status_of": STATUS, "partial": PARTIAL}

ORACLE = {
    "classify_attempts": oracle(
        "SELECT event_id, query, page, try_no, outcome FROM {classified}", classified=CLASSIFIED),
    "page_outcome": oracle(
        "SELECT query, page, outcome, try_no FROM {pages_tried}",
        classified=CLASSIFIED, pages_tried=PAGES),
    "partial_results": oracle(
        "SELECT query, page, stop, n_items, status, usable FROM {partial}", **STEPS),
    "query_status": oracle("""
        SELECT query, max(status) AS status,
               CAST(coalesce(sum(CASE WHEN usable THEN n_items END), 0) AS BIGINT) AS n_items
        FROM {partial} GROUP BY query""", **STEPS),
    "unique_links_capped": oracle("""
        SELECT query, page, pos, link, title FROM (
            SELECT *, row_number() OVER (PARTITION BY query ORDER BY page, pos) AS place
            FROM (SELECT *, row_number() OVER (PARTITION BY query, link ORDER BY page, pos) AS copy
                  FROM {items} WHERE link <> '') WHERE copy = 1)
        WHERE place <= 30"""),
    "item_date": oracle("SELECT query, page, pos, published FROM {items}"),
    "flatten_items": oracle("""
        SELECT c.c_name AS query, coalesce(i.page, 0) AS page, coalesce(i.pos, 0) AS pos,
               c.c_name AS Person, coalesce(i.title, '') AS Title, coalesce(i.published, '') AS Date,
               coalesce(i.host, '') AS Source, coalesce(i.link, '') AS Link
        FROM customer c LEFT JOIN {items} i ON i.query = c.c_name"""),
    "query_results": oracle("""
        SELECT query, string_agg(link, ' ' ORDER BY page, pos) AS links
        FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY page, pos) AS place
              FROM {items}) WHERE place <= 100 GROUP BY query"""),
    "links_only": oracle("SELECT query, query_ord, page, pos, link FROM {items} WHERE link IS NOT NULL"),
    "results_per_query": oracle("""
        SELECT c_name AS query, count(i.query) AS n_results
        FROM customer LEFT JOIN {items} i ON i.query = c_name GROUP BY c_name"""),
}
