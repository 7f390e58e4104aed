"""Text expressions that follow Python's string rules where results depend on them."""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import Column, functions as F

from .binding import let

# The characters Python's str.split()/str.strip() treat as whitespace, as a class
# body for regular expressions and as plain characters below and above U+1680.
WHITESPACE = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
NARROW_SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
WIDE_SPACES = (
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Single Latin-1 characters compile to a bit set, several times faster than a union of ranges.
_NARROW = "".join(rf"\x{ord(c):02x}" for c in NARROW_SPACES)


def _narrowed(text: Column) -> Column:
    """Wide whitespace replaced by plain spaces, behind two cheap tests that most texts fail.

    Bound once: the text is often a long chain of replacements itself.
    """
    def narrowed(value: Column) -> Column:
        wide = value.rlike(r"[\x{1680}-\x{ffff}]") & contains_any(value, list(WIDE_SPACES))
        return F.when(wide, F.regexp_replace(value, f"[{WIDE_SPACES}]", " ")).otherwise(value)

    return let(text, narrowed)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(NARROW_SPACES + WIDE_SPACES))


def strip_chars(text: Column, chars: str) -> Column:
    """Remove any of ``chars`` (plain characters) from both ends."""
    members = "".join("\\" + c for c in chars)
    return F.regexp_replace(text, rf"^[{members}]+|[{members}]+\z", "")


def collapse(text: Column) -> Column:
    """Whitespace runs become one space, ends trimmed."""
    return F.trim(F.regexp_replace(_narrowed(text), f"[{_NARROW}]+", " "))


def is_blank(text: Column) -> Column:
    """Null, empty or whitespace only."""
    return ~F.coalesce(text.rlike(rf"[^{WHITESPACE}]"), F.lit(False))


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(_narrowed(text), f"[{_NARROW}]+", -1), ""))


def paragraph_count(text: Column) -> Column:
    return F.size(F.split(text, "\n\n", -1))


def any_of(words: list[str], levels: int = 4) -> str:
    """Pattern for any of the words, shared first letters factored out.

    A flat alternation of a thousand words is tried word by word at every position of a text;
    grouped by their first letters only one group of them is.
    """
    if levels == 0 or len(words) < 2:
        return "(?:" + "|".join(re.escape(word) for word in words) + ")"
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[:1], []).append(word[1:])
    branches = [
        re.escape(first) + any_of(rests, levels - 1) if first else ""
        for first, rests in sorted(groups.items(), reverse=True)]
    return "(?:" + "|".join(branches) + ")"


def contains_any(text: Column, tokens: list[str]) -> Column:
    found = F.lit(False)
    for token in tokens:
        found = found | text.contains(token)
    return found


def unquote(text: Column) -> Column:
    """Percent-decode; ``+`` and malformed escapes stay as they are."""
    guarded = F.replace(
        F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(text.contains("%"), F.try_url_decode(guarded)).otherwise(text)


def truthy(text: Column) -> Column:
    # The spellings that switch a boolean setting on.
    return F.coalesce(F.lower(strip(text)).isin("1", "true", "yes"), F.lit(False))


def to_int(text: Column) -> Column:
    return strip(text).try_cast("int")


def fill_template(template: str, **values: Column) -> Column:
    """``str.format`` over columns: ``{name}`` fields become the given columns."""
    pieces: list[Column] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is not None:
            pieces.append(values[field])
    return F.concat(*pieces) if pieces else F.lit("")
