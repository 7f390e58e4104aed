"""Key-value settings: change-log compaction and layered overrides, for all tenants at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_blank


def resolve_params(log: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Current value per case-insensitive key of a log (ord, Key, Value).

    Blank keys are dropped. Per exact spelling the last value counts; among spellings that differ
    in case only, the one that was first seen last decides.
    """
    scope = scope or []
    spelled = (
        log.where(~is_blank(F.col("Key"))).groupBy(*scope, "Key")
        .agg(F.min("ord").alias("__first"), F.max_by("Value", "ord").alias("__value")))
    return (
        spelled.groupBy(*scope, F.lower("Key").alias("key"))
        .agg(F.max_by("__value", "__first").alias("value")))


def layer_settings(layers: list[DataFrame], scope: list[str] | None = None) -> DataFrame:
    """First non-empty value per key over layers (key, value), highest precedence first.

    A union and one combined aggregation rather than a chain of full outer joins.
    """
    scope = scope or []
    stacked = None
    for number, layer in enumerate(layers):
        one = layer.select(
            *scope, F.lower("key").alias("key"), "value", F.lit(number).alias("layer"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return (
        stacked.where("value IS NOT NULL AND value <> ''").groupBy(*scope, "key")
        .agg(F.min_by("value", "layer").alias("value"), F.min("layer").alias("layer")))
