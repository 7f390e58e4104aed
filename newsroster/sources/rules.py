"""The wide rule sheet, turned into rule lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip

KINDS = {"domain": "Domains", "stop_word": "Stop Words", "link": "Links to Remove"}


def blacklist_rules(sheet: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Rules (kind, value, replacement, ord) of a sheet (ord + five text columns).

    The five columns are independent lists. A rename needs both sides; for a repeated old name
    the last row counts.
    """
    scope = scope or []

    def cell(name: str) -> Column:
        return strip(F.coalesce(F.col(f"`{name}`"), F.lit("")))

    old, new = cell("Rewrite (Old)"), cell("Rewrite (New)")
    lists = F.array(*[
        F.struct(F.lit(kind).alias("kind"), cell(column).alias("value"),
                 F.lit(None).cast("string").alias("replacement"))
        for kind, column in KINDS.items()])
    rename = F.struct(
        F.lit("rename").alias("kind"), F.when(new != "", old).otherwise("").alias("value"),
        new.alias("replacement"))
    rules = (
        sheet.select(*scope, "ord", F.explode(F.concat(lists, F.array(rename))).alias("rule"))
        .select(*scope, "ord", "rule.*").where("value <> ''"))
    plain = rules.where("kind <> 'rename'").select(*scope, "kind", "value", "replacement", "ord")
    renames = (
        rules.where("kind = 'rename'").groupBy(*scope, "kind", "value")
        .agg(F.max_by("replacement", "ord").alias("replacement"), F.max("ord").alias("ord")))
    return plain.unionByName(renames)


def values_of(rules: DataFrame, kind: str) -> DataFrame:
    """One rule list as a one-column table."""
    return rules.where(F.col("kind") == kind).select("value")


def renames_of(rules: DataFrame) -> DataFrame:
    return rules.where("kind = 'rename'").select(
        F.col("value").alias("old"), F.col("replacement").alias("new"))
