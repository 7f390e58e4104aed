"""Daily run and resume as a stream: each landed file is taken in once, whatever stops a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import ingest
from ..plans.collect import collect
from ..schema import LANDED
from ..sinks.delta_state import DeltaState, bucket_of
from ..sinks.state_store import StateStore
from ..sources.payloads import explode_items, with_items


def ok_items(landed: DataFrame) -> DataFrame:
    """Raw rows of the successful attempts; row-wise, so batch and stream give the same."""
    attempts = ingest.classify_attempts(with_items(landed)).where("outcome = 'ok'")
    items = explode_items(attempts)
    return items.select(
        "query_ord", "page", "try_no", "pos",
        *ingest.item_row(F.col("query"), F.col("item")))


def resume(
    spark: SparkSession, landed_path: str, out_path: str, checkpoint: str,
    max_files: int | None = None, file_format: str = "parquet",
):
    """Take in everything that landed since the last run, then stop.

    A batch writes its own folder and overwrites it if it is run again after a failure, so the
    output holds every row once.
    """
    reader = spark.readStream.schema(LANDED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = ok_items(reader.format(file_format).load(landed_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    query = (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def resume_runs(
    spark: SparkSession, roster: DataFrame, landed_path: str, attempts_path: str,
    store: StateStore, checkpoint: str, file_format: str = "parquet", **options,
):
    """Collect runs as a stream into the resume state: each batch of landed files is one run.

    A batch is added to the attempts seen so far, and the queries it touches go through
    ``collect`` (which takes ``options``) with all their attempts. So stops, quota, retries and
    give-ups hold as in the batch job, a query whose pages come in over several days is done
    when the last is there, and a batch that brings nothing for a query does not count its
    failure again. A batch that is run again after a crash is recognized by the note in the state
    and applied once.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        added = f"{attempts_path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(added)
        source, _, last = store.note().rpartition(" ")
        if source == checkpoint and int(last) >= batch_id:
            return
        touched = spark.read.schema(LANDED).parquet(added).select("query").distinct()
        attempts = spark.read.schema(LANDED).parquet(attempts_path).select(*LANDED.names)
        run = collect(roster, attempts.join(touched, "query", "left_semi"), *store.load(), **options)
        store.save(run.completed, run.failures, f"{checkpoint} {batch_id}")

    query = (
        spark.readStream.schema(LANDED).format(file_format).load(landed_path)
        .writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def resume_delta(
    spark: SparkSession, roster: DataFrame, landed_path: str, state: DeltaState, checkpoint: str,
    file_format: str = "parquet", compact_every: int | None = None, **options,
):
    """Collect runs as a stream into delta state: each batch of landed files is one run.

    A batch stores its attempts by query bucket, reads the history, completed queries and failure
    ledger of the buckets it touches only, collects the queries it touches, and writes just what
    changed: newly finished queries and new ledger entries. Failures are counted once per run that
    had them (attempts without a run count as run ``batch_id``), so a failure that stays in the
    history is not counted again by later batches. A batch run again after a crash finds its
    commit and does nothing, or, without one, overwrites its folders. ``compact_every`` merges the
    deltas into a base after so many batches.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        if batch_id in state.committed():
            return
        attempts = batch.select(*LANDED.names).withColumn(
            "run", F.coalesce("run", F.lit(batch_id)).cast("int"))
        attempts.withColumn("bucket", bucket_of(F.col("query"), state.buckets)).repartition("bucket") \
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{state.path}/attempts/batch={batch_id}")
        fresh = spark.read.parquet(f"{state.path}/attempts/batch={batch_id}")
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` rows
        queries = fresh.select("query").distinct()
        history = state.table("attempts", touched, also=batch_id).join(queries, "query", "left_semi")
        completed = state.table("completed", touched).join(queries, "query", "left_semi")
        ledger = state.table("ledger", touched).join(queries, "query", "left_semi")
        run = collect(roster, history, completed, state.failures(ledger), ledger=ledger, **options)
        new_entries = run.ledger.join(ledger, ["query", "run"], "left_anti")
        state.write(batch_id, completed=run.done, ledger=new_entries)
        if compact_every and (batch_id + 1) % compact_every == 0:
            state.compact()

    query = (
        spark.readStream.schema(LANDED).format(file_format).load(landed_path)
        .writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
