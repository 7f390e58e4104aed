"""Enrichment from fetched pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.text import WHITESPACE
from ..operators import enrich as E
from .landed import Landed, oracle


def html_to_text(spark, folder):
    return Landed(spark, folder).pages.select(
        "page_id", H.page_text(F.col("html")).alias("page_text"))


def article_body(spark, folder):
    return Landed(spark, folder).dated_pages.select(
        "page_id", H.article_body(F.col("html")).alias("article"))


def publish_date(spark, folder):
    return Landed(spark, folder).dated_pages.select(
        "page_id", H.publish_date(F.col("html"), F.col("url")).alias("day"))


def page_facts(spark, folder):
    """One row per URL, whole texts."""
    return E.page_facts(Landed(spark, folder).dated_pages)


def article_text(spark, folder):
    """Article over existing text over page text."""
    rows = Landed(spark, folder).dated_pages.select(
        "page_id", H.article_body(F.col("html")).alias("article"),
        F.when(F.col("url").like("%/4%"), F.col("url")).alias("existing"),
        H.page_text(F.col("html")).alias("page_text"))
    return rows.select("page_id", E.merge_text(
        F.col("article"), F.col("existing"), F.col("page_text")).alias("title_text"))


def date_cut(spark, folder):
    return E.cut_date(Landed(spark, folder).mentions)


def fill_blanks(spark, folder):
    landed = Landed(spark, folder)
    return E.fill_blanks(landed.mentions, E.page_facts(landed.dated_pages)).withColumnRenamed(
        "Title text", "title_text")


QUERIES = {
    "html_to_text": html_to_text, "article_body": article_body, "publish_date": publish_date,
    "page_facts": page_facts, "article_text": article_text, "date_cut": date_cut,
    "fill_blanks": fill_blanks,
}


def sql_visible(html: str) -> str:
    return (f"regexp_replace(regexp_replace({html}, '(?s)<!--.*?-->', '', 'g'), "
            r"'(?is)<(script|style|template)\b[^>]*>.*?</(script|style|template)\s*>', '', 'g')")


def sql_text(marked: str) -> str:
    text = f"regexp_replace({marked}, '(?s)<[!/a-zA-Z][^>]*>', '', 'g')"
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"),
                         ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&")]:
        text = f"replace({text}, '{entity}', '{char}')"
    return f"trim(regexp_replace({text}, '[{WHITESPACE}]+', ' ', 'g'))"


def _sql_outermost(html: str, tag: str) -> str:
    """Outermost closed elements by depth: clamped depth is the prefix sum less its running minimum
    (never above zero). Each value is bound once as the parameter of a one-element list's lambda."""
    pattern = rf"'(?i)</?{tag}\b[^>]*>'"

    def bind(value: str, name: str, body: str) -> str:
        return f"(list_transform([{value}], lambda {name}: {body}))[1]"

    kept = ("nullif(array_to_string(list_filter(list_transform(dd, lambda x, k: CASE WHEN x >= 1 AND k < "
            "coalesce(list_max(list_transform(dd, lambda y, j: CASE WHEN y = 0 THEN j END)), 0) THEN "
            "(CASE WHEN k > 1 AND dd[k - 1] = 0 THEN '</p>' ELSE '' END) || pieces[k + 1] END), "
            "lambda z: z IS NOT NULL), ''), '')")
    depths = bind("list_transform(ps, lambda x, i: x - least(0, list_min(list_slice(ps, 1, i))))", "dd", kept)
    sums = bind("list_transform(st, lambda x, i: list_sum(list_slice(st, 1, i)))", "ps", depths)
    steps = bind("list_transform(tg, lambda t: CASE WHEN t[2] = '/' THEN -1 ELSE 1 END)", "st", sums)
    tags = bind(f"regexp_extract_all(hh, {pattern})", "tg", steps)
    pieces = bind(f"regexp_split_to_array(hh, {pattern})", "pieces", tags)
    return bind(html, "hh", pieces)


def sql_article(html: str) -> str:
    def inner(tag):
        return _sql_outermost(sql_visible(html), tag)

    blocks = (r"'(?i)</(p|div|h[1-6]|li|ul|ol|section|blockquote|tr|table|pre|figure)\s*>"
              r"|<br\s*/?>'")
    marked = (f"regexp_replace(coalesce({inner('article')}, {inner('main')}), {blocks}, "
              "chr(1), 'g')")
    joined = (f"regexp_replace({sql_text(marked)}, ' *' || chr(1) || '[ ' || chr(1) || ']*', "
              "chr(10) || chr(10), 'g')")
    return f"nullif(trim({joined}, chr(10)), '')"


PAGE_FACTS = f"""
    SELECT url, {sql_article('html')} AS article,
           {sql_text(sql_visible('html'))} AS page_text, day AS page_date
    FROM (SELECT p.*, d.day, row_number() OVER (PARTITION BY p.url ORDER BY p.page_id) AS copy
          FROM {{dated_pages}} p JOIN {{dates}} d ON d.page_id = p.page_id) WHERE copy = 1"""
# Where the view put a date.
DATES = """
    SELECT p.page_id, CASE WHEN l.host LIKE 'm.%' OR l.host LIKE 'blog.%' OR l.host LIKE 'www.%'
                             OR l.host LIKE '%.net' THEN strftime(e.ts, '%Y-%m-%d') END AS day
    FROM pages p JOIN {links} l ON l.page_id = p.page_id JOIN events e ON e.event_id = p.page_id"""

ORACLE = {
    "html_to_text": f"SELECT page_id, {sql_text(sql_visible('html'))} AS page_text FROM pages",
    "article_body": oracle(f"SELECT page_id, {sql_article('html')} AS article FROM {{dated_pages}}"),
    "publish_date": oracle("SELECT page_id, day FROM {dates}", dates=DATES),
    "page_facts": oracle("SELECT * FROM {facts}", dates=DATES, facts=PAGE_FACTS),
    "article_text": oracle(f"""
        SELECT page_id, coalesce({sql_article('html')},
                                 CASE WHEN url LIKE '%/4%' THEN url END,
                                 {sql_text(sql_visible('html'))}) AS title_text
        FROM {{dated_pages}}"""),
    "date_cut": oracle("""
        SELECT ord, Person, Title, CASE WHEN Link <> '' THEN left(Date, 10) ELSE Date END AS Date,
               Source, Link FROM {mentions}"""),
    "fill_blanks": oracle("""
        SELECT m.ord, m.Person, m.Title,
               CASE WHEN m.Link <> '' THEN left(coalesce(m.Date, f.page_date), 10)
                    ELSE m.Date END AS Date,
               m.Source, m.Link, coalesce(f.article, f.page_text) AS title_text
        FROM {mentions} m LEFT JOIN {facts} f ON f.url = m.Link""", dates=DATES, facts=PAGE_FACTS),
}
