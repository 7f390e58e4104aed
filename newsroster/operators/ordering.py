"""Total orders, positions and running totals without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

_PART, _SLOT = "__part", "__slot"


def order_by(columns: list[str], ascending: bool | list[bool] = True, tie: str | None = "ord"):
    """Sort expressions with nulls last in both directions and an explicit tie-break."""
    flags = [ascending] * len(columns) if isinstance(ascending, bool) else list(ascending)
    if len(flags) != len(columns):
        raise ValueError(f"{len(columns)} sort columns but {len(flags)} directions")
    keys = [
        F.asc_nulls_last(f"`{c}`") if up else F.desc_nulls_last(f"`{c}`")
        for c, up in zip(columns, flags)
    ]
    return keys + ([F.asc_nulls_last(f"`{tie}`")] if tie and tie not in columns else [])


def sort_rows(
    df: DataFrame,
    columns: str | list[str],
    ascending: bool | list[bool] = True,
    tie: str | None = "ord",
) -> DataFrame:
    """Global sort; a range shuffle, never one partition."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.orderBy(*order_by(columns, ascending, tie if tie in df.columns else None))


def as_ranked(sorted_rows: DataFrame, name: str = "rank") -> DataFrame:
    """Number the rows of a globally sorted table as they leave it.

    The partitions of the sort are pinned and numbered in their order, so the ranks show the
    order that was in fact produced.
    """
    placed = cut_lineage(
        sorted_rows.withColumn(_PART, F.spark_partition_id())
        .withColumn(_SLOT, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    based, _ = _with_base(placed, placed.groupBy(_PART).count())
    return based.withColumn(name, F.col("__base") + F.col(_SLOT) + 1).drop(_PART, _SLOT, "__base")


def _placed(df: DataFrame, keys: list[Column], slot: Column | None = None) -> DataFrame:
    """Range-partition by ``keys`` and pin every row's partition and slot on shared storage.

    Range bounds come from a sample, so a re-run could cut elsewhere; after the checkpoint all
    later jobs see one and the same layout. With a unique tie-break among the keys no value,
    however frequent, makes a partition large.
    """
    ranged = (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_SLOT, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    return cut_lineage(ranged)


def _with_base(placed: DataFrame, amounts: DataFrame) -> tuple[DataFrame, int]:
    """Add ``__base``: the total amount of all earlier partitions. Also return the grand total.

    The driver sees one number per partition, never a row of data.
    """
    totals = sorted((r[0], r[1]) for r in amounts.collect())
    base, running = {}, 0
    for part, amount in totals:
        base[part] = running
        running += amount
    if not base:
        return placed.withColumn("__base", F.lit(0).cast("long")), 0
    lookup = placed.sparkSession.createDataFrame(
        list(base.items()), f"{_PART} int, __base long")
    # One row per shuffle partition: Spark broadcasts it by its size.
    return placed.join(lookup, _PART), running


def with_position(df: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """1-based position of every row in the total order ``keys``."""
    return positions(df, keys, name)[0]


def positions(df: DataFrame, keys: list[Column], name: str) -> tuple[DataFrame, int]:
    """``with_position`` plus the row count."""
    placed = _placed(df, keys)
    based, total = _with_base(placed, placed.groupBy(_PART).count())
    return (
        based.withColumn(name, F.col("__base") + F.col(_SLOT) + 1)
        .drop(_PART, _SLOT, "__base")), total


def with_running_total(df: DataFrame, keys: list[Column], amount: str, name: str) -> DataFrame:
    """Inclusive running sum of the integer column ``amount`` in the total order ``keys``."""
    placed = _placed(df, keys)
    based, _ = _with_base(placed, placed.groupBy(_PART).agg(F.sum(amount).cast("long")))
    # Windows stay within one range partition each; several of them share a task at most.
    inside = Window.partitionBy(_PART).orderBy(_SLOT).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        based.withColumn(name, F.col("__base") + F.sum(amount).over(inside))
        .drop(_PART, _SLOT, "__base"))
