"""Log records as a stream into the shared log table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.log_rows import application_rows, number_batches


def _next_batch(spark: SparkSession, out_path: str, batch_id: int) -> int:
    """The first log batch number of micro-batch ``batch_id``: what the marker of the latest earlier
    micro-batch holds, 0 if none. Markers are written after the rows, so a replay reads the same."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out_path}/_next")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    earlier = [int(e.getPath().getName()) for e in fs.listStatus(folder)
               if e.getPath().getName().isdigit() and int(e.getPath().getName()) < batch_id]
    if not earlier:
        return 0
    return int(spark.read.text(f"{out_path}/_next/{max(earlier)}").first()[0])


def _mark(spark: SparkSession, out_path: str, batch_id: int, following: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out_path}/_next/{batch_id}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.writeBytes(str(following))
    out.close()


def ship_logs(
    spark: SparkSession, records_path: str, schema: StructType, out_path: str, checkpoint: str,
    max_files: int | None = None, batch_size: int | None = None,
):
    """Append application log rows batch by batch; a repeated batch overwrites itself.

    With ``batch_size`` the rows also get ``log_batch`` and ``position`` as ``log_batches`` gives them,
    and batch numbers go on from one micro-batch to the next: a small marker per micro-batch holds
    the next number, read by the following one. As the original flushes its buffer at the end of
    a run, a log batch does not reach over a micro-batch; rows of one micro-batch in one run give
    the batches of ``log_batches``.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = application_rows(reader.parquet(records_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        following = None
        if batch_size:
            first = _next_batch(spark, out_path, batch_id)
            batch, used = number_batches(batch, batch_size, first)
            batch = batch.withColumnRenamed("batch", "log_batch")  # folders are named batch=
            following = first + used
        (batch.sortWithinPartitions(batch["ts"].desc(), batch["event_id"].desc())
         .write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}"))
        if following is not None:
            _mark(spark, out_path, batch_id, following)

    query = (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
