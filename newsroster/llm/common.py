"""Text and table helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

# The blanks between words, as text and as a pattern.
BLANKS = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The column as text; null is empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text: its runs of characters that are not blanks, in order."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def constant_array(values: list[float]) -> Column:
    """A bounded model as one constant: the optimizer folds it into a single literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def sampled_ids(rows: DataFrame, name: str, most: int, salt: str) -> DataFrame:
    """At most ``most`` distinct non-null ids, chosen by hash: the same ones in every run."""
    ids = rows.select(F.col(f"`{name}`").alias("id")).where(F.col("id").isNotNull()).distinct()
    return ids.orderBy(F.xxhash64(F.lit(salt), "id"), "id").limit(most)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, lost executors do
    no harm, and the planner knows the true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
