"""Scans and rule sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ingest import item_date
from ..schema import BLACKLIST, ROSTER
from ..session import scratch_path
from ..sinks.files import write_csv
from ..sources import payloads
from ..sources.files import read_csv, read_ragged_csv
from ..sources.rules import blacklist_rules
from .landed import Landed, oracle

KEYED = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "Person", "Title", "Date")])


def scan_csv(spark, folder):
    """Write whole documents as CSV cells, read them back with missing words as null."""
    rows = Landed(spark, folder).documents.select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("Person"),
        F.col("text").alias("Title"),
        F.when(F.col("lang") == "de", "n/a").when(F.col("lang") == "fr", "")
        .when(F.col("lang") == "es", "NaN").otherwise(F.col("lang")).alias("Date"), "lang")
    path = scratch_path(spark, "scan_csv")
    write_csv(rows.where("lang <> 'de'").drop("lang"), f"{path}/one")
    # The same columns in another order, and one that nobody asked for.
    write_csv(rows.where("lang = 'de'").select("Date", F.col("lang").alias("Extra"), "Title", "id", "Person"),
              f"{path}/two")
    return read_csv(spark, [f"{path}/one", f"{path}/two"], KEYED)


def scan_ragged(spark, folder):
    """Sheet exports whose rows stop at their last filled cell."""
    cells = F.array("priority", "member_eng", "member_ukr", "spellings")
    quoted = F.transform(cells, lambda c: F.concat(
        F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
    width = F.when(F.col("spellings") != "", 4).when(F.col("member_ukr") != "", 3).otherwise(2)
    lines = Landed(spark, folder).roster.select(F.array_join(
        F.slice(quoted, F.lit(1), width), ",").alias("value"))
    path = scratch_path(spark, "scan_ragged")
    # Whole lines under the header line of a sheet, one sheet per part file; nothing is quoted.
    (lines.withColumnRenamed("value", ",".join(ROSTER.names)).write.option("header", True)
     .option("sep", "\u0001").option("quote", "").option("escapeQuotes", False).csv(path))
    rows = read_ragged_csv(spark, path, ROSTER)
    return rows.select(
        F.col("Priority").alias("priority"), F.col("Member ENG").alias("member_eng"),
        F.col("Member UKR").alias("member_ukr"), F.col("Pronounciations").alias("spellings"))


def _item_columns(rows):
    return rows.select(
        "event_id", "query", "page", "pos", F.col("item.title").alias("title"),
        F.col("item.link").alias("link"), F.col("item.displayLink").alias("source"),
        item_date(F.col("item")).alias("published"))


def scan_items(spark, folder):
    pages = payloads.with_items(Landed(spark, folder).landed())
    search = pages.where(~payloads.is_meta(F.col("provider")))
    return _item_columns(payloads.explode_items(search))


def scan_meta_items(spark, folder):
    """Meta-dialect attempts, one row per result; a bad body keeps one row without one."""
    pages = payloads.with_items(Landed(spark, folder).landed())
    meta = pages.where(payloads.is_meta(F.col("provider")) & (F.col("status") == 200))
    return meta.select("event_id", "bad_body", F.posexplode_outer("items").alias("pos", "item")).select(
        "event_id", "bad_body", "pos", F.col("item.title").alias("title"),
        F.col("item.link").alias("link"), item_date(F.col("item")).alias("published"))


def scan_mixed(spark, folder):
    pages = payloads.with_items(Landed(spark, folder).landed())
    return pages.select(
        "event_id", payloads.is_meta(F.col("provider")).alias("meta"), "bad_body",
        F.when(F.col("items").isNotNull(), F.size("items")).cast("long").alias("n_items"))


def normalize_items(spark, folder):
    """Meta results mapped to the search shape."""
    hits = Landed(spark, folder).items
    result = F.struct(
        F.col("title"), F.col("link").alias("url"), F.col("published").alias("publishedDate"))
    return hits.select("query", "page", "pos", payloads.to_item(result).alias("item")).select(
        "query", "page", "pos", F.col("item.title").alias("title"), F.col("item.link").alias("link"),
        F.col("item.displayLink").alias("source"),
        F.col("item.pagemap").isNotNull().alias("dated"), item_date(F.col("item")).alias("published"))


def rules_sheet(landed):
    sheet = landed.rule_sheet
    for old, new in zip(("domains", "stop_words", "links", "old", "new"), BLACKLIST.names):
        sheet = sheet.withColumnRenamed(old, new)
    return sheet


def blacklist(spark, folder):
    return blacklist_rules(rules_sheet(Landed(spark, folder)), ["tenant"])


QUERIES = {
    "scan_csv": scan_csv, "scan_ragged": scan_ragged, "scan_items": scan_items,
    "scan_meta_items": scan_meta_items, "scan_mixed": scan_mixed,
    "normalize_items": normalize_items, "blacklist_rules": blacklist,
}

_META = "provider = ' SearXNG '"
_LISTED = "status = 200 AND body_kind = 'list'"
_BAD = "(status <> 200 OR body_kind = 'junk')"

ORACLE = {
    "scan_csv": oracle("""
        SELECT CAST(doc_id AS VARCHAR) AS id, source AS Person, nullif(text, '') AS Title,
               CASE WHEN lang NOT IN ('de', 'fr', 'es') THEN lang END AS Date FROM documents"""),
    "scan_ragged": oracle(
        "SELECT priority, member_eng, member_ukr, spellings FROM {roster}"),
    "scan_items": oracle(f"""
        SELECT a.event_id, a.query, a.page, i.pos, i.title, i.link, i.host AS source, i.published
        FROM {{attempts}} a JOIN {{attempt_items}} i ON i.event_id = a.event_id
        WHERE NOT {_META} AND {_LISTED}"""),
    "scan_meta_items": oracle(f"""
        SELECT a.event_id, body_kind = 'junk' AS bad_body, i.pos,
               i.title, i.link, i.published
        FROM {{attempts}} a LEFT JOIN {{attempt_items}} i
          ON i.event_id = a.event_id AND body_kind = 'list'
        WHERE {_META} AND status = 200"""),
    "scan_mixed": oracle(f"""
        SELECT a.event_id, {_META} AS meta, {_BAD} AS bad_body,
               CASE WHEN {_LISTED} THEN (SELECT count(*) FROM {{attempt_items}} i
                                         WHERE i.event_id = a.event_id) END AS n_items
        FROM {{attempts}} a"""),
    "normalize_items": oracle("""
        SELECT query, page, pos, title, link, coalesce(regexp_extract(link, '//([^/?#]*)', 1), '') AS source,
               published IS NOT NULL AS dated, published FROM {items}"""),
    "blacklist_rules": oracle(f"""
        SELECT tenant, 'domain' AS kind, trim(domains) AS value, CAST(NULL AS VARCHAR) AS replacement, ord
        FROM {{rule_sheet}} WHERE trim(domains) <> ''
        UNION ALL SELECT tenant, 'stop_word', trim(stop_words), NULL, ord
        FROM {{rule_sheet}} WHERE trim(stop_words) <> ''
        UNION ALL SELECT tenant, 'link', trim(links), NULL, ord
        FROM {{rule_sheet}} WHERE trim(links) <> ''
        UNION ALL SELECT tenant, 'rename', trim(old), arg_max(trim(new), ord), max(ord)
        FROM {{rule_sheet}} WHERE trim(old) <> '' AND trim(new) <> '' GROUP BY tenant, trim(old)"""),
}
