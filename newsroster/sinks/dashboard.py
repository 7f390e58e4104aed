"""Keyed upsert of the dashboard table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip


def upsert(board: DataFrame, changes: DataFrame) -> DataFrame:
    """Set values by key in (ord, key, value); unknown keys are appended in their given order.

    Keys match trimmed. Where a key stands on several rows, the last of them is the one updated.
    ``changes``: (ord, key, value), unique keys, few rows by nature.
    """
    wanted = changes.select(
        F.col("key").alias("__key"), F.col("value").alias("__new"), F.col("ord").alias("__pos"))
    keyed = board.withColumn("__key", strip(F.col("key")))
    targets = (
        keyed.join(wanted, "__key", "left_semi").groupBy("__key")
        .agg(F.max("ord").alias("__ord")))
    updates = targets.join(wanted, "__key").select("__ord", "__new")
    rows = (
        board.join(updates, F.col("ord") == F.col("__ord"), "left")
        .select("ord", "key", F.when(F.col("__ord").isNotNull(), F.col("__new"))
                .otherwise(F.col("value")).alias("value")))
    last = board.agg(F.max("ord")).first()[0]  # one number: where the new rows go
    appended = wanted.join(targets, "__key", "left_anti").select(
        (F.lit(-1 if last is None else last) + 1 + F.col("__pos")).alias("ord"),
        F.col("__key").alias("key"), F.col("__new").alias("value"))
    return rows.unionByName(appended)
