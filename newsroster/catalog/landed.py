"""The landed tables of the catalogue, derived from the given tables.

Each view is one SQL text that Spark and DuckDB both run; ``{name}`` stands for another view or a
base table. Views read their tables whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.payloads import is_meta

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

VIEWS = {
    # One search hit per page. The hint (a comment elsewhere) keeps the title extraction out of
    # the joins below, where it would run once per match.
    "links": """
        SELECT /*+ REPARTITION(page_id) */ page_id, url, regexp_extract(url, '//([^/?#]*)', 1) AS host,
               regexp_extract(html, '<title>([^<]*)</title>', 1) AS title
        FROM {pages}""",
    # Every event is a hit on a page; "other" is a second page of the same hit.
    "hits": """
        SELECT event_id, ts, user_id, event_type, value,
               event_id % (SELECT count(*) FROM {pages}) AS hit,
               (event_id + user_id) % (SELECT count(*) FROM {pages}) AS other
        FROM {events}""",
    # One mention per event: about forty copies per link, one group of null links, and some links
    # with blanks and tabs that do not change their host.
    "mentions": """
        SELECT e.event_id AS ord, n.n_name AS Person,
               CASE WHEN e.event_type = 'signup' THEN NULL ELSE l.title END AS Title,
               CASE WHEN e.event_type = 'error' THEN NULL
                    ELSE substring(CAST(e.ts AS VARCHAR(40)), 1, 19) END AS Date,
               l.host AS Source,
               CASE WHEN e.value < 1 THEN NULL WHEN e.value < 1.3 THEN ' ' || chr(10) || l.url
                    WHEN e.value < 1.6 THEN replace(l.url, 'example', 'exam' || chr(9) || 'ple')
                    ELSE l.url END AS Link
        FROM {hits} e JOIN {links} l ON l.page_id = e.hit
        JOIN {nation} n ON n.n_nationkey = e.user_id % 25""",
    # A chain of renames, of which a name takes one step only.
    "rename_rules": """
        SELECT a.n_name AS old, b.n_name AS new
        FROM {nation} a JOIN {nation} b ON b.n_nationkey = a.n_nationkey + 1""",
    # Hosts of the pages with a feed tag, cut to their registered part; one upper-case rule that
    # must match nothing.
    "domain_rules": """
        SELECT DISTINCT CASE WHEN title LIKE '%&amp;%' THEN upper(host)
                             ELSE regexp_extract(host, '([a-z-]+.example.[a-z]+)', 1) END AS rule
        FROM {links} WHERE url LIKE '%utm_source=feed'""",
    "word_rules": """
        SELECT DISTINCT regexp_extract(url, '(/[a-z][a-z]/[0-9]+)', 1) AS rule
        FROM {links} WHERE url LIKE '%#top'""",
    # Short lists, as a person keeps them.
    "few_domains": """
        SELECT rule FROM (VALUES ('spam-farm.example.org'), ('cheap-pills.example.com'),
                                 ('blog.tionsh'), ('Example.NET')) AS r(rule)""",
    "few_words": "SELECT rule FROM (VALUES ('utm_source'), ('#top')) AS r(rule)",
    "few_patterns": "SELECT rule FROM (VALUES ('/fr/'), ('page=2.ref')) AS r(rule)",
    "roster": """
        SELECT c_custkey AS ord,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN ' Optional ' ELSE 'Definitely' END AS priority,
               ' ' || c_name || ' ' AS member_eng,
               CASE WHEN c_acctbal < 0 THEN '' ELSE 'UA ' || c_name END AS member_ukr,
               CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE')
                    THEN c_name || ' A, "' || c_name || ' B", ,' ELSE '' END AS spellings
        FROM {customer}""",
    # One rule sheet per nation.
    "rule_sheet": """
        SELECT c_custkey AS ord, c_nationkey AS tenant, ' ' || lower(c_mktsegment) || '.org' AS domains,
               CASE WHEN c_acctbal < 500 THEN '  ' ELSE lower(c_mktsegment) END AS stop_words,
               CASE WHEN c_acctbal > 5000 THEN NULL ELSE '/' || c_name END AS links,
               ' ' || c_mktsegment AS old,
               CASE WHEN c_acctbal < 0 THEN ' ' ELSE c_name || ' ' END AS new
        FROM {customer}""",
    "attempts": """
        SELECT e.event_id, c.c_name AS query, c.c_custkey AS query_ord,
               CASE WHEN c.c_mktsegment IN ('MACHINERY', 'BUILDING') THEN ' SearXNG '
                    ELSE 'google' END AS provider,
               CAST((day(e.ts) - 1) % 3 + 1 AS INT) AS page, CAST(day(e.ts) % 2 AS INT) AS run,
               CAST(row_number() OVER (PARTITION BY c.c_custkey, (day(e.ts) - 1) % 3, day(e.ts) % 2
                                       ORDER BY e.ts, e.event_id) AS INT) AS try_no,
               CASE WHEN e.event_type = 'error' THEN 500 WHEN e.value > 150 THEN 429
                    WHEN e.event_type = 'purchase' AND e.value < 10 THEN 403 ELSE 200 END AS status,
               CASE WHEN e.event_type = 'purchase' AND e.value < 5 THEN 'Quota exceeded for metric'
                    WHEN e.event_type = 'purchase' AND e.value < 10 THEN 'missing a valid key'
                    ELSE '' END AS message,
               CASE WHEN e.value BETWEEN 100 AND 105 THEN 'junk'
                    WHEN e.event_type = 'signup' AND e.value < 50 THEN 'missing'
                    ELSE 'list' END AS body_kind
        FROM {events} e JOIN {customer} c ON c.c_custkey = e.user_id""",
    "attempt_items": """
        SELECT e.event_id, e.user_id, CAST((day(e.ts) - 1) % 3 + 1 AS INT) AS page, s.pos, l.title,
               CASE WHEN s.shift = 1 AND e.value < 2 THEN '' ELSE l.url END AS link, l.host,
               CASE WHEN s.shift = 1 THEN NULL
                    ELSE substring(CAST(e.ts AS VARCHAR(40)), 1, 19) END AS published
        FROM {hits} e
        JOIN (VALUES ('view', 0, 0), ('view', 1, 1), ('view', 2, 0), ('click', 0, 0),
                     ('purchase', 0, 1)) AS s(kind, pos, shift) ON s.kind = e.event_type
        JOIN {links} l ON l.page_id = CASE WHEN s.shift = 1 THEN e.other ELSE e.hit END""",
    # Items per query and page, flat.
    "items": """
        SELECT c.c_name AS query, c.c_custkey AS query_ord, i.page, i.event_id * 3 + i.pos AS pos,
               i.title, i.link, i.host, i.published
        FROM {attempt_items} i JOIN {customer} c ON c.c_custkey = i.user_id""",
    "stored": """
        SELECT c_name AS query, c_custkey AS query_ord, c_mktsegment AS title,
               'https://stored.example.org/' || c_name AS link
        FROM {customer} WHERE c_acctbal > 9000""",
    "failure_counts": """
        SELECT c_name AS query, CAST(CASE WHEN c_acctbal < 1000 THEN 2 ELSE 1 END AS INT) AS n
        FROM {customer} WHERE c_acctbal < 3000""",
    "log_records": """
        SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
               CASE event_type WHEN 'click' THEN 'gspread.client' WHEN 'purchase' THEN 'google.auth'
                    WHEN 'signup' THEN 'urllib3.pool' WHEN 'view' THEN 'google_like_name'
                    ELSE 'main' END AS logger_name, props AS message
        FROM {events}""",
    "board": """
        SELECT CAST(c_custkey AS BIGINT) AS ord,
               CASE WHEN c_mktsegment = 'BUILDING' THEN ' raw_csv_link ' ELSE c_name END AS key,
               c_mktsegment AS value FROM {customer}""",
    # A change log of settings per user: mixed case, blank keys.
    "setting_log": """
        SELECT event_id AS ord, user_id AS tenant,
               CASE WHEN value < 1 THEN ' ' WHEN event_id % 3 = 0 THEN upper(event_type)
                    ELSE event_type END AS Key,
               CAST(event_id AS VARCHAR(12)) AS Value FROM {events}""",
    "date_texts": """
        SELECT o_orderkey,
               CASE o_orderpriority
                    WHEN '1-URGENT' THEN substring(CAST(o_orderdate AS VARCHAR(40)), 1, 10)
                    WHEN '2-HIGH' THEN replace(substring(CAST(o_orderdate AS VARCHAR(40)), 1, 10), '-', '')
                    WHEN '3-MEDIUM' THEN ' ' || CAST(year(o_orderdate) AS VARCHAR(4)) || '-' ||
                         CAST(month(o_orderdate) AS VARCHAR(2)) || '-' ||
                         CAST(day(o_orderdate) AS VARCHAR(2)) || ' '
                    WHEN '5-LOW' THEN '2024-02-30' ELSE 'n/a' END AS s
        FROM {orders}""",
    # Pages with a publication date in one of four places, and without <article> for two languages.
    "dated_pages": """
        SELECT p.page_id,
               CASE WHEN l.host LIKE 'm.%'
                    THEN 'https://' || l.host || '/' || replace(e.day, '-', '/') || '/x'
                    ELSE p.url END AS url,
               CASE WHEN l.host LIKE 'blog.%' THEN replace(e.html, '<style>',
                         '<meta property="article:published_time" content="' || e.day || 'T10:00:00Z"><style>')
                    WHEN l.host LIKE 'www.%' THEN replace(e.html, '<style>',
                         '<script>"datePublished": "' || e.day || '"</script><style>')
                    WHEN l.host LIKE '%.net' THEN replace(e.html, '<footer>',
                         '<time datetime="' || e.day || '"><footer>')
                    ELSE e.html END AS html
        FROM {pages} p JOIN {links} l ON l.page_id = p.page_id
        JOIN (SELECT q.page_id, substring(CAST(v.ts AS VARCHAR(40)), 1, 10) AS day,
                     CASE WHEN q.url LIKE '%page=2%' THEN replace(q.html, '<footer>',
                               '<nav>menu</nav><article>second <p>part</p></article><footer>')
                          WHEN q.url LIKE '%/es/%' THEN replace(q.html, 'article>', 'section>')
                          WHEN q.url LIKE '%/de/%' THEN replace(q.html, 'article>', 'main>')
                          ELSE q.html END AS html
              FROM {pages} q JOIN {events} v ON v.event_id = q.page_id) e ON e.page_id = p.page_id""",
    "link_answers": """
        SELECT l.url AS Link, a.answer, a.error
        FROM {links} l JOIN {answers} a ON a.doc_id = l.page_id""",
    "paragraphs": """
        SELECT doc_id, CASE WHEN lang = 'en' THEN replace(text, chr(10), chr(10) || chr(10))
                            ELSE text END AS text
        FROM {documents}""",
    "texts": """
        SELECT doc_id, source AS person, CASE WHEN lang = 'de' THEN NULL
                    ELSE source || ' in ' || lang END AS title,
               CASE WHEN n_chars < 100 THEN NULL ELSE text END AS title_text
        FROM {documents}""",
    "answers": """
        SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Score: ' || CAST(doc_id % 7 AS VARCHAR(4))
                    WHEN doc_id % 5 = 1 THEN 'no digit' WHEN doc_id % 5 = 2 THEN ''
                    ELSE CAST(quality * 3 + 1 AS VARCHAR(4)) END AS answer,
               CASE WHEN quality = 1 THEN ' Yes.' WHEN toxic = 1 THEN '' ELSE 'No' END AS yes_no,
               doc_id % 13 = 0 AS error
        FROM {labels}""",
}

_REF = re.compile(r"(?<!\\x)\{([a-z]\w*)\}")


def needed(names: list[str]) -> list[str]:
    """The views behind ``names``, each after those it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE or name in order:
            return
        for ref in _REF.findall(VIEWS[name]):
            visit(ref)
        order.append(name)

    for name in names:
        visit(name)
    return order


def oracle(body: str, **extra: str) -> str:
    """SQL with the views that ``body`` names in braces as common table expressions.

    ``extra``: further common table expressions, in order, for this body alone.
    """
    refs = [r for text in [*extra.values(), body] for r in _REF.findall(text) if r not in extra]
    ctes = [f"{name} AS ({_REF.sub(r'\1', VIEWS[name]).strip()})" for name in needed(refs)]
    ctes += [f"{name} AS ({_REF.sub(r'\1', text).strip()})" for name, text in extra.items()]
    head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
    return head + _REF.sub(r"\1", body).strip()


class Landed:
    """Tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        refs = {ref: getattr(self, ref) for ref in set(_REF.findall(VIEWS[name]))}
        return self.spark.sql(VIEWS[name], **refs)

    def listed(self, name: str) -> list[str]:
        """A short rule view as a Python list."""
        return [row[0] for row in getattr(self, name).collect()]

    def landed(self) -> DataFrame:
        """Attempts with their response bodies, in the dialect of their provider."""
        lists = self.attempt_items.groupBy("event_id").agg(F.sort_array(F.collect_list(
            F.struct("pos", "title", "link", "host", "published"))).alias("hits"))
        none = F.array().cast(lists.schema["hits"].dataType)
        rows = self.attempts.join(lists, "event_id", "left").withColumn(
            "hits", F.coalesce("hits", none))
        dated = lambda hit: F.when(hit["published"].isNotNull(), F.struct(F.array(F.create_map(
            F.lit("article:published_time"), hit["published"])).alias("metatags")))
        search = F.to_json(F.struct(F.transform("hits", lambda hit: F.struct(
            hit["title"].alias("title"), hit["link"].alias("link"),
            hit["host"].alias("displayLink"), dated(hit).alias("pagemap"))).alias("items")))
        meta = F.to_json(F.struct(F.transform("hits", lambda hit: F.struct(
            hit["title"].alias("title"), hit["link"].alias("url"),
            hit["published"].alias("publishedDate"))).alias("results")))
        body = (
            F.when(F.col("status") != 200, F.lit("")).when(F.col("body_kind") == "junk", "<html>")
            .when(F.col("body_kind") == "missing", "{}")
            .when(is_meta(F.col("provider")), meta).otherwise(search))
        return rows.select(
            "event_id", "query", "query_ord", "provider", "run", "page", "try_no", "status", "message",
            body.alias("body"))
