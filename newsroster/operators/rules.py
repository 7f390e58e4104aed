"""Rule lists: Python lists become literals, tables stay tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def literal_rules(rules) -> list[str] | None:
    """The distinct rules of a Python list, or None for a table. The caller chooses by type: a
    list is short enough to be part of the plan, a table may have any length."""
    return None if isinstance(rules, DataFrame) else sorted(set(rules))


def rule_table(spark: SparkSession, rules, name: str) -> DataFrame:
    """One-column table of the distinct rules."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r,) for r in rules], f"{name} string")
    return (
        rules.select(F.col(f"`{rules.columns[0]}`").alias(name))
        .where(F.col(name).isNotNull()).distinct())
