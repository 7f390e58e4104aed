"""Cleaning and ordering of mentions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators.ordering import as_ranked, order_by, sort_rows, with_position
from .landed import Landed, oracle


def dedup_links(spark, folder):
    return C.dedup_links(Landed(spark, folder).mentions)


def rename_person(spark, folder):
    landed = Landed(spark, folder)
    return C.rename_people(landed.mentions, landed.rename_rules)


def remove_by_links(spark, folder):
    landed = Landed(spark, folder)
    return C.remove_by_links(landed.mentions, landed.listed("few_patterns"))


def domain_blacklist(spark, folder):
    landed = Landed(spark, folder)
    return C.drop_blocked_domains(landed.mentions, landed.listed("few_domains"))


def domain_blacklist_keys(spark, folder):
    """Rules as a table, however many."""
    landed = Landed(spark, folder)
    return C.drop_blocked_domains(landed.mentions, landed.domain_rules)


def url_stop_words(spark, folder):
    landed = Landed(spark, folder)
    return C.drop_links_with(landed.mentions, landed.listed("few_words"))


def url_stop_words_keys(spark, folder):
    """Stop words as a table, however many."""
    landed = Landed(spark, folder)
    return C.drop_links_with(landed.mentions, landed.word_rules)


def url_filter(spark, folder):
    landed = Landed(spark, folder)
    return C.url_filter(landed.mentions, landed.listed("few_domains"), landed.listed("few_words"))


def sort_one(spark, folder):
    rows = Landed(spark, folder).mentions
    return with_position(rows, order_by(["Title"], True))


def sort_many(spark, folder):
    rows = Landed(spark, folder).mentions
    return with_position(rows, order_by(["Person", "Date"], [True, False]))


def sorted_rows(spark, folder):
    """The global sort itself, and the place at which each row leaves."""
    return as_ranked(sort_rows(Landed(spark, folder).mentions, ["Source", "Title"], [False, True]))


def review_top_k(spark, folder):
    """The twenty mentions a reviewer sees first, titles scored by length."""
    rows = Landed(spark, folder).mentions.withColumn(
        "Relevance", F.size(F.split(F.coalesce("Title", F.lit("")), " ")) % 6)
    return C.ranked_for_review(rows).limit(20)


def funnel_counts(spark, folder):
    landed = Landed(spark, folder)
    rules = [landed.listed(name) for name in ("few_domains", "few_words", "few_patterns")]
    return C.funnel(landed.mentions, *rules)


def lead_columns(spark, folder):
    rows = Landed(spark, folder).mentions.withColumn("Relevance", F.col("ord") % 6)
    return C.lead_columns_first(rows)


QUERIES = {
    "dedup_links": dedup_links, "rename_person": rename_person, "remove_by_links": remove_by_links,
    "domain_blacklist": domain_blacklist, "domain_blacklist_keys": domain_blacklist_keys,
    "url_stop_words": url_stop_words, "url_stop_words_keys": url_stop_words_keys,
    "url_filter": url_filter, "sort_one": sort_one, "sort_many": sort_many,
    "sorted_rows": sorted_rows, "review_top_k": review_top_k, "funnel_counts": funnel_counts,
    "lead_columns": lead_columns,
}

DEDUPED = """
    SELECT ord, Person, Title, Date, Source, Link FROM (
        SELECT *, row_number() OVER (PARTITION BY Link ORDER BY ord) AS copy FROM {mentions})
    WHERE copy = 1"""
HOST = (r"regexp_replace(regexp_extract(lower(regexp_replace(m.Link, '^[\x00-\x20]+|[\t\r\n]', '', 'g')), "
        "'^([a-z][a-z0-9+.-]*:)?//([^/?#]*)', 2), '^www[.]', '')")
# Whether any rule of the table named %s matches the host.
BLOCKED = f"""EXISTS (SELECT 1 FROM {{%s}} r WHERE {HOST} = r.rule
    OR {HOST} LIKE '%%.' || r.rule OR {HOST} LIKE r.rule || '.%%')"""
WORDED = "EXISTS (SELECT 1 FROM {%s} w WHERE contains(lower(m.Link), w.rule))"
PATTERNED = "coalesce(regexp_matches(m.Link, (SELECT string_agg(rule, '|') FROM {few_patterns})), false)"


def _kept(*dropped: str, source: str = "{mentions}") -> str:
    return f"SELECT m.* FROM {source} m WHERE " + " AND ".join(f"NOT ({d})" for d in dropped)


ORACLE = {
    "dedup_links": oracle(DEDUPED),
    "rename_person": oracle("""
        SELECT m.ord, coalesce(r.new, m.Person) AS Person, m.Title, m.Date, m.Source, m.Link
        FROM {mentions} m LEFT JOIN {rename_rules} r ON r.old = m.Person"""),
    "remove_by_links": oracle(_kept(PATTERNED)),
    "domain_blacklist": oracle(_kept(BLOCKED % "few_domains")),
    "domain_blacklist_keys": oracle(_kept(BLOCKED % "domain_rules")),
    "url_stop_words": oracle(_kept(WORDED % "few_words")),
    "url_stop_words_keys": oracle(_kept(WORDED % "word_rules")),
    "url_filter": oracle(_kept("m.Link IS NULL", BLOCKED % "few_domains", WORDED % "few_words")),
    "sort_one": oracle("""
        SELECT *, row_number() OVER (ORDER BY Title ASC NULLS LAST, ord) AS rank FROM {mentions}"""),
    "sort_many": oracle("""
        SELECT *, row_number() OVER (ORDER BY Person, Date DESC NULLS LAST, ord) AS rank
        FROM {mentions}"""),
    "sorted_rows": oracle("""
        SELECT *, row_number() OVER (ORDER BY Source DESC NULLS LAST, Title NULLS LAST, ord) AS rank
        FROM {mentions}"""),
    "review_top_k": oracle("""
        SELECT *, CAST(len(string_split(coalesce(Title, ''), ' ')) % 6 AS INT) AS Relevance
        FROM {mentions} ORDER BY Relevance DESC, Date DESC NULLS LAST, ord LIMIT 20"""),
    "funnel_counts": oracle("""
        SELECT 1 AS step_no, 'raw' AS step, count(*) AS rows FROM {mentions}
        UNION ALL SELECT 2, 'deduplicated', count(*) FROM {deduped}
        UNION ALL SELECT 3, 'links_removed', count(*) FROM {allowed}
        UNION ALL SELECT 4, 'url_filtered', count(*) FROM {filtered}""",
        deduped=DEDUPED, allowed=_kept(PATTERNED, source="{deduped}"),
        filtered=_kept("m.Link IS NULL", BLOCKED % "few_domains", WORDED % "few_words",
                       source="{allowed}")),
    "lead_columns": oracle("""
        SELECT ord % 6 AS Relevance, Person, Title, Date, Source, Link, ord FROM {mentions}"""),
}
