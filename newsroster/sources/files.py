"""CSV scans with fixed schemas."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schema import RAW

# The cell texts a CSV load takes for missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


HEAD_BYTES = 1 << 20  # a header line longer than this is cut there


def _files_of(spark: SparkSession, path) -> list[str]:
    """Data files below the paths, as Spark's file index lists them (hidden files left out)."""
    paths = [path] if isinstance(path, str) else list(path)
    return sorted(spark.read.format("binaryFile").load(paths).select("path").inputFiles())


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file, read through Hadoop's file system in blocks of 64 KB up to its
    first newline (at most ``HEAD_BYTES``), whatever the size of the file; None if it is empty."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(file)
    stream = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).open(hpath)
    data = b""
    try:
        while len(data) < HEAD_BYTES and b"\n" not in data:
            block = bytes(stream.readNBytes(65536))
            if not block:
                break
            data += block
    finally:
        stream.close()
    if not data:
        return None
    return data.split(b"\n", 1)[0][:HEAD_BYTES].decode("utf-8", "replace").rstrip("\r")


def headers(spark: SparkSession, path) -> dict[tuple[str, ...], list[str]]:
    """Files by their header: its column names in order. A header is the first line of a file.

    Only the head of each file is read, by the driver through Hadoop's file system (any store Spark
    reads), a few files at a time; empty files have no header and are left out.
    """
    from concurrent.futures import ThreadPoolExecutor

    files = _files_of(spark, path)
    with ThreadPoolExecutor(max_workers=8) as pool:
        heads = list(pool.map(lambda f: _first_line(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, heads):  # one line per file
        if header is None:
            continue
        names = tuple(next(csv.reader([header.removeprefix("\ufeff")]), []))
        found.setdefault(names, []).append(file)
    return found


def _cells(spark: SparkSession, path, schema: T.StructType, *more: Column) -> DataFrame:
    """The columns of ``schema`` by their names in each file's header; null where a file has no
    such column, other columns left out. Files of one header are scanned together."""
    def scan(names: tuple[str, ...], files: list[str]) -> DataFrame:
        kinds = {f.name: f.dataType for f in schema.fields}
        columns = [name if names.index(name) == k else f"{name} {k}" for k, name in enumerate(names)]
        rows = (
            spark.read.schema(T.StructType([
                T.StructField(c, kinds.get(c, T.StringType())) for c in columns]))
            .option("header", True).option("multiLine", True).option("escape", '"').csv(files))
        return rows.select(*more, *[
            F.col(f"`{f.name}`") if f.name in columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields])

    groups = sorted(headers(spark, path).items())
    if not groups:
        empty = spark.createDataFrame([], schema)
        return empty.select(*[F.lit(None).alias("ord") for _ in more], "*")
    return reduce(DataFrame.unionByName, [scan(names, files) for names, files in groups])


def _with_missing(name: str, kind: T.DataType) -> Column:
    cell = F.col(f"`{name}`")
    return F.when(~cell.isin(MISSING), cell).alias(name) if isinstance(kind, T.StringType) else cell


def read_csv(spark: SparkSession, path, schema: T.StructType = RAW) -> DataFrame:
    """Header CSV with quoted commas, quotes and newlines; missing-value words become null.

    Columns are found by header name, whatever their order.
    """
    return _cells(spark, path, schema).select(
        *[_with_missing(f.name, f.dataType) for f in schema.fields])


def read_ragged_csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Exported sheets, many at once: short rows are padded with '', long rows cut, columns found
    by header name."""
    return _cells(spark, path, schema).select(*[
        F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) for name in schema.names])


def without_missing(rows: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """The cells of ``schema`` with missing-value words as null, as a CSV load would give them."""
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in schema.names]
    return rows.select(*kept, *[_with_missing(f.name, f.dataType) for f in schema.fields])


def read_mentions(spark: SparkSession, path, schema: T.StructType = RAW) -> DataFrame:
    """Exported CSV with ``ord``, the place of a row in its export.

    A quoted newline keeps a file in one task, so ids rise with the lines of a file; part files
    are numbered in row order by the writer.
    """
    name = F.col("_metadata.file_name")
    place = F.struct(
        F.coalesce(F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), F.lit(0)).alias("part"),
        name.alias("file"), F.monotonically_increasing_id().alias("row"))
    return without_missing(_cells(spark, path, schema, place.alias("ord")), schema)
