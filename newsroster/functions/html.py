"""Page HTML to text, article body and publication date, as column expressions.

Apply these straight after the page scan: html is the widest column of the system and must not
travel through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .binding import let
from .dates import iso_day
from .text import collapse

# The named entities decoded, "&amp;" last so that nothing is decoded twice.
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"),
    ("&nbsp;", " "), ("&amp;", "&"),
]
COMMENT = r"(?s)<!--.*?-->"
UNSEEN = r"(?is)<(?:script|style|template)\b[^>]*>.*?</(?:script|style|template)\s*>"
TAG = r"(?s)<[!/a-zA-Z][^>]*>"
# Tags that end a block of prose.
BLOCK_END = r"(?i)</(?:p|div|h[1-6]|li|ul|ol|section|blockquote|tr|table|pre|figure)\s*>|<br\s*/?>"


def visible(html: Column) -> Column:
    """Html without comments, scripts, styles and templates."""
    return F.regexp_replace(F.regexp_replace(html, COMMENT, ""), UNSEEN, "")


def _decode(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def text_of(visible_html: Column) -> Column:
    return collapse(_decode(F.regexp_replace(visible_html, TAG, "")))


def outermost(html: Column, tag: str) -> Column:
    """What the outermost closed elements of a kind hold, one beginning a new paragraph after
    another; null if nothing.

    The opening and closing tags of the kind are counted in order: depth rises at an opening tag
    and falls at a closing one, never below zero (a stray closing tag is passed over). The text
    between tags counts where the depth is one or more and a later tag brings it back to zero, so
    nested elements stay inside their outer one and an element left open counts not. Linear in the
    length of the page; the list of depths is grown tag by tag, so quadratic in the number of tags
    of that kind on one page only.
    """
    pattern = rf"(?i)</?{tag}\b[^>]*>"

    def scan(both: Column) -> Column:
        tags, pieces = both["tags"], both["pieces"]
        steps = F.transform(tags, lambda t: F.when(F.substring(t, 2, 1) == "/", -1).otherwise(1))
        depths = F.aggregate(steps, F.array().cast("array<int>"), lambda acc, step: F.concat(acc, F.array(
            F.greatest(F.lit(0), F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + step).cast("int"))))

        def kept(d: Column) -> Column:
            last_zero = F.array_max(F.transform(d, lambda x, i: F.when(x == 0, i)))
            parts = F.transform(d, lambda x, k: F.when((x >= 1) & (k < last_zero), F.concat(
                F.when((k > 0) & (F.try_element_at(d, k) == 0), F.lit("</p>")).otherwise(F.lit("")),
                F.element_at(pieces, k + 2))))
            return F.array_join(parts, "")

        return let(depths, kept)

    found = let(F.struct(F.regexp_extract_all(html, F.lit(f"({pattern})"), F.lit(1)).alias("tags"),
                         F.split(html, pattern).alias("pieces")), scan)
    return let(found, lambda text: F.when(text != "", text))


def article_of(visible_html: Column) -> Column:
    # U+0001 marks block ends while whitespace is collapsed around it.
    marked = F.regexp_replace(F.coalesce(outermost(visible_html, "article"), outermost(visible_html, "main")),
                              BLOCK_END, "\u0001")
    flat = collapse(_decode(F.regexp_replace(marked, TAG, "")))
    joined = F.btrim(F.regexp_replace(flat, " *\u0001[ \u0001]*", "\n\n"), F.lit("\n"))
    return let(joined, lambda text: F.when(text != "", text))


def page_text(html: Column) -> Column:
    """All visible text, tags dropped without a separator, whitespace collapsed."""
    return text_of(visible(html))


def article_body(html: Column) -> Column:
    """Text of all outermost ``<article>``, else of all outermost ``<main>`` (nested ones inside
    their outer one), paragraphs apart by a blank line; else null."""
    return let(visible(html), article_of)


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"<title>([^<]*)</title>", 1)


def publish_date(html: Column, url: Column) -> Column:
    """Day of first publication: meta tag, JSON-LD, ``<time>``, then a date in the URL path."""
    name = r"(?:property|name|itemprop)\s*=\s*[\"'](?:article:published_time|datePublished)[\"']"
    content = r"content\s*=\s*[\"']([^\"']*)[\"']"
    in_path = F.regexp_replace(
        F.regexp_extract(url, r"/([0-9]{4}/[0-9]{2}/[0-9]{2})(?:/|\z)", 1), "/", "-")

    # The cheap substring tests keep the pattern scans off pages that cannot match.
    named = html.contains("article:published_time") | html.contains("datePublished")

    def scan(possible: Column, pattern: str) -> Column:
        return iso_day(F.when(possible, F.regexp_extract(html, pattern, 1)))

    return F.coalesce(
        scan(named, rf"(?s)<(?i:meta)\b[^>]*{name}[^>]*{content}"),
        scan(named, rf"(?s)<(?i:meta)\b[^>]*{content}[^>]*{name}"),
        scan(named, r'"datePublished"\s*:\s*"([^"]*)"'),
        scan(html.contains("datetime"),
             r"(?s)<(?i:time)\b[^>]*datetime\s*=\s*[\"']([^\"']*)[\"']"),
        iso_day(in_path))
