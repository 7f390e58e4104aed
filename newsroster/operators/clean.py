"""Removal of duplicate and unwanted mentions, renaming, projection and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.window import Window

from ..functions import urls
from ..functions.patterns import literals_of
from ..functions.text import any_of
from ..session import cut_lineage
from .ordering import sort_rows
from .rules import literal_rules, rule_table

LEAD_COLUMNS = ["Relevance", "Person", "Title", "Date", "Source", "Link"]
# Length of the pieces of links and words that serve as join keys for rules in a table.
PIECE = 6
PATTERNS_PER_SCAN = 200  # alternatives in one regular expression; only splits the expression


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys form one group.

    The rank filter is applied before the shuffle too (window group limit), so a key that holds
    a third of all rows sends one row per task, not its group.
    """
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def dedup_links(df: DataFrame) -> DataFrame:
    """First row of every link by ``ord`` (a number, or a struct such as file and position)."""
    return first_per_key(df, ["Link"], [F.col("ord")])


def rename_people(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Exact-match replacement, not chained; ``rules`` has one (old, new) row per old name.

    No broadcast hint: Spark broadcasts the rules only below its size threshold and otherwise
    sorts and merges, splitting frequent names at run time.
    """
    lookup = rules.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    return (
        df.join(lookup, F.col("Person") == F.col("__old"), "left")
        .withColumn("Person", F.coalesce("__new", "Person")).drop("__old", "__new"))


def pattern_hit(patterns: list[str]) -> Column:
    """Whether the link matches any of some regular expressions; false for a null link."""
    hit = F.lit(False)
    for at in range(0, len(patterns), PATTERNS_PER_SCAN):
        joined = "|".join(patterns[at:at + PATTERNS_PER_SCAN])
        hit = hit | F.coalesce(F.col("Link").rlike(joined), F.lit(False))
    return hit


def domain_hit(domains: list[str]) -> Column:
    if not domains:
        return F.lit(False)
    host = urls.domain(F.col("Link"))
    return F.coalesce(urls.matches_domain(host, domains), F.lit(False))


def word_hit(words: list[str], lower: bool = True) -> Column:
    if not words:
        return F.lit(False)
    link = F.lower("Link") if lower else F.col("Link")
    return F.coalesce(link.rlike(any_of(words)), F.lit(False))


def remove_by_links(df: DataFrame, patterns, literal: bool = False) -> DataFrame:
    """Drop rows whose link matches any pattern; null links stay, no patterns drop nothing.

    Patterns are regular expressions, or plain substrings with ``literal``. Those of a table are
    joined on a literal that each of them must contain (or, with groups and alternatives, on each
    of the literals one of which every match holds; ``functions.patterns``) and checked on the
    matches; only those without any such literal (``[a-z]+``, flags, Unicode classes) are scanned
    for, chunk by chunk, and that list is what reaches the driver.
    """
    if literal:
        return drop_links_with(df, patterns, lower=False)
    values = literal_rules(patterns)
    if values is not None:
        return df.where(~pattern_hit(values))
    rules = rule_table(df.sparkSession, patterns, "__rule").withColumn(
        "__word", needed_literal(F.col("__rule")))
    # Groups and alternatives: one rule row per literal of which every match holds one.
    rest = rules.where("__word IS NULL").withColumn("__alts", literals_of(F.col("__rule")))
    split = rest.where("__alts IS NOT NULL").select("__rule", F.explode("__alts").alias("__word"))
    plain = [r[0] for r in rest.where("__alts IS NULL").select("__rule").collect()]
    blocked = _links_holding(
        df, rules.where("__word IS NOT NULL").select("__rule", "__word").unionByName(split), F.col("Link"),
        F.rlike("__text", "__rule"))
    return df.where(~pattern_hit(sorted(plain))).join(blocked, "Link", "left_anti").select(*df.columns)


def needed_literal(pattern: Column) -> Column:
    """The longest literal that every match of a regular expression holds, or null if none is
    easy to tell: patterns with groups, classes, escapes, counts or alternatives have none here.
    """
    simple = ~pattern.rlike(r"[|()\[\]{}\\]")
    parts = F.split(F.regexp_replace(pattern, r".[*?][+?]?|[.^$+]", "\u0001"), "\u0001")
    longest = F.sort_array(F.transform(parts, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))), False)
    return F.when(simple, F.nullif(F.get(longest, F.lit(0))["x"], F.lit("")))


def drop_blocked_domains(df: DataFrame, domains) -> DataFrame:
    """Drop links whose host equals a rule, ends with ``.rule`` or starts with ``rule.``.

    A list becomes one scan-time pattern. A table is joined on host keys: first the distinct
    hosts against the rules, then the mentions against the blocked hosts.
    """
    values = literal_rules(domains)
    if values is not None:
        return df.where(~domain_hit(values))
    host = urls.domain(F.col("Link"))
    rules = rule_table(df.sparkSession, domains, "__key")
    hosts = df.select(host.alias("__host")).where("__host IS NOT NULL").distinct()
    blocked = (
        hosts.withColumn("__key", F.explode(urls.domain_keys(F.col("__host"))))
        .join(rules, "__key", "left_semi").select("__host").distinct())
    return df.withColumn("__host", host).join(blocked, "__host", "left_anti").drop("__host")


def drop_links_with(df: DataFrame, words, lower: bool = True) -> DataFrame:
    """Drop links that contain any of the words; only the link is lower-cased.

    A list becomes one scan-time pattern, a table is joined.
    """
    values = literal_rules(words)
    if values is not None:
        return df.where(~word_hit(values, lower))
    rules = rule_table(df.sparkSession, words, "__word")
    link = F.lower("Link") if lower else F.col("Link")
    blocked = _links_holding(df, rules, link, F.col("__text").contains(F.col("__word")))
    return df.join(blocked, "Link", "left_anti").select(*df.columns)


def _pieces(text: Column, sizes: list[int]) -> Column:
    """All distinct substrings of the given lengths."""
    def cut(size: int) -> Column:
        last = F.length(text) - size + 1
        return F.when(last > 0, F.transform(
            F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(size)))).otherwise(
            F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[cut(size) for size in sizes])))


def _links_holding(df: DataFrame, rules: DataFrame, link: Column, check: Column) -> DataFrame:
    """Distinct links that hold a rule's ``__word`` and pass ``check``.

    "Contains" has no join key, so a piece of the word serves as one: of all its pieces that
    which the fewest distinct links hold. What many words and links share (a scheme, a common
    host or path) is thus never joined on. Pieces of links are counted only where a rule has the
    same piece, with partial sums before the shuffle. An empty word is in every link.
    """
    texts = df.select("Link", link.alias("__text")).where("__text IS NOT NULL").distinct()
    words = rules.select("__word").distinct()
    lengths = [r[0] for r in words.select(
        F.least(F.length("__word"), F.lit(PIECE)).alias("n")).distinct().collect()]  # PIECE + 1 at most
    sizes = sorted(n for n in lengths if n)
    if not sizes:
        cut = texts.withColumn("__piece", F.lit(""))
    else:
        cut = texts.withColumn("__piece", F.explode(_pieces(F.col("__text"), sizes)))
    if 0 in lengths and sizes:
        cut = cut.unionByName(texts.withColumn("__piece", F.lit("")))
    own = F.when(F.length("__word") > PIECE, _pieces(F.col("__word"), [PIECE])).otherwise(
        F.array("__word"))
    offered = words.withColumn("__piece", F.explode(own))
    counts = cut.join(offered.select("__piece").distinct(), "__piece", "left_semi").groupBy(
        "__piece").agg(F.count(F.lit(1)).alias("n"))
    # A word one of whose pieces is in no link is in none either.
    rarest = offered.join(counts, "__piece", "left").groupBy("__word").agg(
        F.min_by("__piece", F.coalesce("n", F.lit(0))).alias("__piece"),
        F.min(F.coalesce("n", F.lit(0))).alias("n")).where("n > 0").drop("n")
    return (
        cut.join(rules.join(rarest, "__word"), "__piece").where(check)
        .select("Link").distinct())


def url_filter(df: DataFrame, domains, words) -> DataFrame:
    """Keep mentions that have a link, are not on a blocked host and hold no stop word."""
    linked = df.where(F.col("Link").isNotNull())
    return drop_links_with(drop_blocked_domains(linked, domains), words)


def ranked_for_review(df: DataFrame) -> DataFrame:
    """Most relevant first, then newest."""
    return sort_rows(df, ["Relevance", "Date"], [False, False])


def lead_columns_first(df: DataFrame, lead: list[str] = LEAD_COLUMNS) -> DataFrame:
    front = [c for c in lead if c in df.columns]
    rest = [c for c in df.columns if c not in front]
    return df.select(*[F.col(f"`{c}`") for c in front + rest])


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows on the way through, in the same pass as the action that runs ``df``."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def funnel(df: DataFrame, domains, words, patterns) -> DataFrame:
    """Rows left after each cleaning step.

    Every step after the first looks at the link alone, so the mentions are reduced to one row
    per distinct link (combined before the shuffle). Rules in lists are flags on those rows and all
    steps are counted in the same pass; with rules in tables the distinct links are pinned and
    counted step by step.
    """
    links = df.groupBy("Link").agg(F.count(F.lit(1)).alias("copies"))
    lists = [literal_rules(rules) for rules in (patterns, domains, words)]
    if None not in lists:
        allowed = ~pattern_hit(lists[0])
        clean = allowed & F.col("Link").isNotNull() & ~domain_hit(lists[1]) & ~word_hit(lists[2])
        counts = links.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("raw"), F.count(F.lit(1)).alias("deduped"),
            F.count_if(allowed).alias("allowed"), F.count_if(clean).alias("clean"))
        return counts.select(F.expr(
            "stack(4, 1, 'raw', raw, 2, 'deduplicated', deduped, 3, 'links_removed', allowed, "
            "4, 'url_filtered', clean) AS (step_no, step, rows)"))
    links = cut_lineage(links)
    allowed = remove_by_links(links, patterns)
    steps = [
        ("raw", links, F.sum("copies")), ("deduplicated", links, F.count(F.lit(1))),
        ("links_removed", allowed, F.count(F.lit(1))),
        ("url_filtered", url_filter(allowed, domains, words), F.count(F.lit(1)))]
    counts = [
        rows.agg(F.coalesce(amount, F.lit(0)).cast("long").alias("rows")).select(
            F.lit(number).alias("step_no"), F.lit(name).alias("step"), "rows")
        for number, (name, rows, amount) in enumerate(steps, 1)]
    return reduce(DataFrame.unionAll, counts)
