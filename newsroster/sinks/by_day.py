"""Landed rows stored by day, so that a date window reads the folders of its days only."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import iso_day
from ..operators.planning import in_date_range

NO_DAY = "none"  # folder of rows whose date text holds no day


def write_by_day(rows: DataFrame, path: str, column: str = "Date", mode: str = "overwrite") -> None:
    """Rows under ``day=yyyy-MM-dd`` by the day their date text starts with, else ``day=none``.

    Rows are sorted by day within each task, so a task keeps one file open at a time; a day that
    holds a third of all rows is written by every task that has some, not by one.
    """
    day = F.coalesce(iso_day(F.col(f"`{column}`")), F.lit(NO_DAY))
    (rows.withColumn("day", day).sortWithinPartitions("day").write.mode(mode)
     .option("maxRecordsPerFile", 1_000_000).partitionBy("day").parquet(path))


def read_days(spark: SparkSession, path: str, start: str | None, end: str | None, today: date) -> DataFrame:
    """Rows whose day lies in the inclusive window, by the rule of ``in_date_range``; no bounds keep
    everything. The window is a filter on the partition column alone, with constant bounds, so the
    scan lists and reads the folders of those days only (``PartitionFilters`` in the plan)."""
    rows = spark.read.parquet(path)
    return in_date_range(rows, "day", start, end, today).drop("day")
