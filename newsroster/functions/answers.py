"""Model answers: text out of the response JSON, scores and decisions out of the text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .text import is_blank, strip


# JSON values that count as nothing. The field names of the response shapes below
# are fixed values as well.
EMPTY = ["null", "false", "0", "0.0", '""', "[]", "{}"]


def _string_at(value: Column, path: str) -> Column:
    """The JSON value at ``path`` if it is a string, else null."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(
        F.schema_of_variant(found) == "STRING", F.try_variant_get(value, path, "string"))


def answer_text(body: Column) -> Column:
    """Trimmed text of a generate-style response; the raw body if no known field holds one.

    Order: ``response``; the entries of ``results`` or else ``choices``; ``output``, ``text``,
    ``content`` at top level. Blank texts are passed over inside entries only.
    """
    doc = F.try_parse_json(body)

    def from_entry(entry: Column) -> Column:
        direct = [_string_at(entry, f"$.{key}") for key in ("content", "text", "output", "message")]
        nested = F.try_variant_get(entry, "$.content", "array<variant>")
        texts = F.filter(
            F.transform(nested, lambda part: F.try_variant_get(part, "$.text", "string")),
            lambda text: text.isNotNull())
        return F.coalesce(
            *[F.when(~is_blank(text), strip(text)) for text in direct],
            strip(F.get(texts, F.lit(0))))

    def at(path: str) -> Column:
        return F.try_variant_get(doc, path, "variant")

    # A filled ``results`` of any kind ends the search for entries, also if it is no list.
    first = F.to_json(at("$.results"))
    filled = first.isNotNull() & ~first.isin(*EMPTY)
    entries = F.when(filled, F.try_variant_get(doc, "$.results", "array<variant>")).otherwise(
        F.try_variant_get(doc, "$.choices", "array<variant>"))
    answers = F.filter(F.transform(entries, from_entry), lambda text: text.isNotNull())
    return F.coalesce(
        strip(_string_at(doc, "$.response")),
        F.get(answers, F.lit(0)),
        *[strip(_string_at(doc, f"$.{key}")) for key in ("output", "text", "content")],
        strip(body))


def chat_answer_text(body: Column) -> Column:
    """Trimmed message of the first choice of a chat-style response."""
    return strip(F.get_json_object(body, "$.choices[0].message.content"))


def parse_score(answer: Column) -> Column:
    """First digit 0-5 of the answer, else null."""
    return F.nullif(F.regexp_extract(answer, "[0-5]", 0), F.lit("")).try_cast("int")


def says_yes(answer: Column) -> Column:
    return F.lower(strip(answer)).startswith("y")


def length_score(words: Column, minimums: list[int]) -> Column:
    """One point for every minimum word count that is reached."""
    return reduce(
        lambda total, least: total + (words >= least).cast("int"), minimums, F.lit(0))
