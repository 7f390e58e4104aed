"""Process: raw mentions to the ranked table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..operators import clean, enrich, relevance
from ..session import cut_lineage
from ..sources import rules as rule_lists


@dataclass(frozen=True)
class Rules:
    """Rule lists; renames as (old, new) rows.

    A Python list becomes part of the plan, a one-column table of any length is joined.
    """

    domains: object = field(default_factory=list)
    stop_words: object = field(default_factory=list)
    links_to_remove: object = field(default_factory=list)
    renames: DataFrame | None = None

    @classmethod
    def from_sheet(cls, sheet: DataFrame) -> "Rules":
        rules = rule_lists.blacklist_rules(sheet)
        return cls(
            rule_lists.values_of(rules, "domain"), rule_lists.values_of(rules, "stop_word"),
            rule_lists.values_of(rules, "link"), rule_lists.renames_of(rules))


def cleaned(mentions: DataFrame, rules: Rules) -> DataFrame:
    """First row per link, people renamed, unwanted links gone.

    Dedup comes before renaming. Every filter looks at the link alone, so Catalyst moves them
    below the dedup shuffle.
    """
    rows = clean.dedup_links(mentions)
    if rules.renames is not None:
        rows = clean.rename_people(rows, rules.renames)
    rows = clean.remove_by_links(rows, rules.links_to_remove)
    return clean.url_filter(rows, rules.domains, rules.stop_words)


def scored(
    mentions: DataFrame, rules: Rules, pages: DataFrame, replies: DataFrame | None = None,
    scorer: relevance.Scorer | None = None, text_limit: int | None = None,
    judge: relevance.Judge | None = None,
) -> DataFrame:
    """Cleaned mentions with texts and dates from ``pages`` and a relevance score.

    ``judge`` drops what is no article before scoring. The cleaned rows are pinned on shared
    storage, so that the costly page stage need not repeat the cleaning if an executor is lost.
    """
    rows = cut_lineage(cleaned(mentions, rules))
    facts = enrich.page_facts(pages, text_limit, wanted=rows)
    filled = enrich.fill_blanks(rows, facts, all_linked=True)
    if judge is not None:
        filled = relevance.filter_with(filled, judge)
    if scorer is not None:
        return relevance.score_with(filled, scorer)
    return relevance.relevance_scores(filled, replies, "Link")


def process(
    mentions: DataFrame, rules: Rules, pages: DataFrame, replies: DataFrame | None = None,
    scorer: relevance.Scorer | None = None, text_limit: int | None = None,
    judge: relevance.Judge | None = None,
) -> DataFrame:
    """The ranked review table, lead columns first. ``replies``: (Link, answer, error)."""
    ranked = clean.ranked_for_review(
        scored(mentions, rules, pages, replies, scorer, text_limit, judge))
    return clean.lead_columns_first(ranked)


def without_order(df: DataFrame) -> DataFrame:
    """The table as exported: ``ord`` is ours."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != "ord"])
