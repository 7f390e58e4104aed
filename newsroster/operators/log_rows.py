"""Log records to the rows and batches of the shared log table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordering import positions

# Logger-name prefixes that are not shipped.
NOISY = [
    "googleapiclient", "google.", "google_auth", "urllib3", "htmldate", "newspaper", "requests",
    "httpx", "httpcore", "gspread", "oauthlib", "feedparser", "charset", "PIL", "chardet",
]


def application_rows(records: DataFrame) -> DataFrame:
    """Drop noisy loggers; project (event_id, ts, level, time, message)."""
    noisy = F.lit(False)
    for prefix in NOISY:
        noisy = noisy | F.col("logger_name").startswith(prefix)
    return records.where(~F.coalesce(noisy, F.lit(False))).select(
        "event_id", "ts", "level",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"), "message")


def number_batches(rows: DataFrame, batch_size: int, first: int = 0) -> tuple[DataFrame, int]:
    """Application rows cut into batches of ``batch_size`` in arrival order (ts, event_id), numbered
    from ``first``; inside a batch the newest row comes first (``position`` 1). Also returns the
    number of batches. The order is a distributed total order, not a single task."""
    numbered, total = positions(rows, [F.col("ts"), F.col("event_id")], "__n")
    local = F.expr(f"(__n - 1) div {batch_size}")
    size = F.least(F.lit(batch_size), F.lit(total) - local * batch_size)
    return numbered.select(
        "event_id", "ts", "level", "time", "message", (local + first).alias("batch"),
        (size - (F.col("__n") - 1 - local * batch_size)).alias("position")), -(-total // batch_size)


def log_batches(records: DataFrame, batch_size: int) -> DataFrame:
    """Number the batches in arrival order; inside a batch the newest row comes first."""
    numbered, _ = number_batches(application_rows(records), batch_size)
    return numbered.drop("ts")
