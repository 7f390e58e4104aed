"""File sinks. Part files are written in parallel; nothing is coalesced into one task."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, functions as F

from ..operators.ingest import links_only


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              per_file: int = 1_000_000) -> None:
    """CSV with doubled quotes, quoted newlines and bare empty cells; row order is kept. Quoted
    newlines make a file readable by one task only, so a file has ``per_file`` rows at most."""
    (df.write.mode(mode).option("maxRecordsPerFile", per_file).option("header", header).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", "").option("nullValue", "").csv(path))


def write_links(items: DataFrame, path: str) -> int:
    """One link per line for (item) rows; returns how many, counted during the write."""
    observation = Observation()
    lines = links_only(items).select("link").observe(
        observation, F.count(F.lit(1)).alias("links"))
    lines.write.mode("overwrite").text(path)
    return observation.get["links"]


def first_query_items(items: DataFrame) -> DataFrame:
    """Items of the first query only, found by one combined minimum."""
    first = items.agg(F.min("query_ord").alias("query_ord"))
    return items.join(first, "query_ord", "left_semi")


def with_verified(df: DataFrame) -> DataFrame:
    """``Verified = false`` as first column unless present."""
    return df if "Verified" in df.columns else df.select(F.lit(False).alias("Verified"), "*")


def append_results(df: DataFrame, path: str, run_id: str | None = None) -> int:
    """Append ranked rows to the result table; returns how many.

    With a ``run_id`` the append is a commit: the rows overwrite the folder ``run=<id>``, then the
    marker ``_published/<id>`` is written. A job that dies before the marker and is repeated with the
    same id replaces its own rows, so every run is in the table once; ``published_results`` reads
    the marked runs only.
    """
    observation = Observation()
    rows = with_verified(df).observe(observation, F.count(F.lit(1)).alias("rows"))
    if run_id is None:
        rows.write.mode("append").parquet(path)
        return observation.get["rows"]
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run_id}")
    spark = df.sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_published/{run_id}")
    jvm.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm, True).close()
    return observation.get["rows"]


def published_runs(spark, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_published")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(e.getPath().getName() for e in fs.listStatus(folder)) if fs.exists(folder) else []


def published_results(spark, path: str) -> DataFrame | None:
    """Rows of the committed runs of a result table, with ``run``; None before the first."""
    runs = published_runs(spark, path)
    if not runs:
        return None
    rows = spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/run={r}" for r in runs])
    return rows.withColumn("run", F.col("run").cast("string"))


def snapshot_name(name: str, at: datetime) -> str:
    return f"{at:%Y-%m-%d_%H-%M}_{name}"


def write_snapshot(df: DataFrame, root: str, name: str, at: datetime) -> str:
    path = f"{root.rstrip('/')}/{snapshot_name(name, at)}"
    write_csv(df, path)
    return path
