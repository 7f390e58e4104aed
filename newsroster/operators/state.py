"""Resume state as two tables, changed by joins and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

GIVE_UP_AFTER = 3


def pending_queries(queries: DataFrame, completed: DataFrame) -> DataFrame:
    return queries.join(completed.select("query"), "query", "left_anti")


def mark_done(completed: DataFrame, failures: DataFrame, done: DataFrame):
    """Upsert results and forget the failures of what is done now."""
    kept = completed.join(done.select("query"), "query", "left_anti")
    return (
        kept.unionByName(done.select(*completed.columns)),
        failures.join(done.select("query"), "query", "left_anti"))


def record_failures(failures: DataFrame, failed: DataFrame) -> DataFrame:
    """Add one failure per failed query (or per row of ``failed``)."""
    return (
        failures.select("query", "n")
        .unionByName(failed.select("query", F.lit(1).alias("n")))
        .groupBy("query").agg(F.sum("n").cast("int").alias("n")))


def give_up(failures: DataFrame, limit: int = GIVE_UP_AFTER) -> DataFrame:
    """Add ``decision``: retry on a later run, or record an empty result."""
    return failures.withColumn(
        "decision", F.when(F.col("n") >= limit, F.lit("give_up")).otherwise(F.lit("retry")))


def abandoned(failures: DataFrame, completed: DataFrame, limit: int = GIVE_UP_AFTER) -> DataFrame:
    """Completed rows, without items, of the queries given up."""
    empty = F.array().cast(completed.schema["items"].dataType)
    return give_up(failures, limit).where("decision = 'give_up'").select(
        "query", empty.alias("items"))


def stored_results(queries: DataFrame, completed: DataFrame) -> DataFrame:
    """Items of every asked query, an empty list where nothing is stored."""
    empty = F.array().cast(completed.schema["items"].dataType)
    return queries.join(completed, "query", "left").withColumn(
        "items", F.coalesce("items", empty))


def run_status(queries: DataFrame, completed: DataFrame) -> DataFrame:
    """One row: how many queries are done and pending, and whether the run is complete."""
    done = completed.select("query", F.lit(1).alias("__done"))
    return (
        queries.select("query").join(done, "query", "left")
        .agg(F.count("__done").alias("done"),
             (F.count(F.lit(1)) - F.count("__done")).alias("pending"))
        .withColumn("complete", F.col("pending") == 0))


def is_complete(queries: DataFrame, completed: DataFrame) -> bool:
    return pending_queries(queries, completed).isEmpty()
