"""URL expressions. Regular expressions rather than a strict parser: no URL may fail the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .binding import let
from .text import any_of


def netloc(url: Column) -> Column:
    """Authority part with user and port kept; empty when the URL has no ``//``.

    Leading controls and blanks do not count, nor do tabs and line breaks anywhere.
    """
    url = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def domain(url: Column) -> Column:
    """Lower-cased authority without one leading ``www.``."""
    return F.regexp_replace(netloc(F.lower(url)), r"^www\.", "")


def domain_keys(host: Column) -> Column:
    """Every run of labels a domain rule can equal.

    A rule matches a host that equals it, ends with ``.rule`` or starts with ``rule.``: exactly
    the hosts with the rule among their label suffixes and label prefixes. That turns the
    three-way string condition into an equality.
    """
    def keys(labels: Column) -> Column:
        n = F.size(labels)
        steps = F.sequence(F.lit(1), n)
        return F.array_union(
            F.transform(steps, lambda i: F.array_join(F.slice(labels, i, n), ".")),
            F.transform(steps, lambda i: F.array_join(F.slice(labels, F.lit(1), i), ".")))

    return let(F.split(host, r"\.", -1), keys)


def matches_domain(host: Column, rules: list[str]) -> Column:
    """The same three-way condition for a short list, as one pattern over the host."""
    names = any_of(rules)
    return host.rlike(rf"^{names}(?:\.|\z)|\.{names}\z")
