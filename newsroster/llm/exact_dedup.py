"""Exact duplicates: 128-bit content hash, then the bytes themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import lower_ascii, text_of


def content_hash(text: Column) -> Column:
    """MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def exact_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    largest: bool = False,
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Groups of equal texts, and the one document of each that stays.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The smallest id
    of a group stays (``largest``: the largest). Returns ``doc_id, keep_id, group_size, kept,
    text_sha256, n_rows``: one row per document, where rows that repeat an id with an equal text
    are one document of ``n_rows`` rows and count one by one in ``group_size``. A null id stays
    only if its group has no other. Other columns are ignored; an empty table gives an empty
    result.

    Rows are grouped by hash and by the text itself, so the engine compares bytes wherever
    hashes agree; each task sends a text once, however many copies it holds. The result of that
    is a row per text without the text, which all documents meet by hash. Only texts whose hash
    stands for several texts go another way: they are joined by hash and bytes.
    """
    rows = docs.select(F.col(f"`{id}`").alias("doc_id"), lower_ascii(text_of(text)).alias("norm"))
    rows = rows.withColumn("h", hashed(F.col("norm")))
    best = F.max("doc_id") if largest else F.min("doc_id")

    def classes(of: DataFrame, *more: str) -> DataFrame:
        return of.groupBy("h", "norm").agg(
            best.alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select(
            "h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size", *more)

    found = cut_lineage(classes(rows))
    shared = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")

    def members(of: DataFrame, *keys: str) -> DataFrame:
        return of.groupBy("doc_id", *keys).agg(F.count(F.lit(1)).alias("n_rows"))

    ids = members(rows, "h")
    if shared.isEmpty():
        joined = ids.join(found, "h")
    else:
        apart = rows.join(shared, "h", "left_semi")
        joined = (
            ids.join(shared, "h", "left_anti").join(found, "h").drop("h")
            .unionByName(members(apart, "h", "norm").join(classes(apart, "norm"), ["h", "norm"])
                         .drop("h", "norm")))
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "n_rows")


def drop_exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", largest: bool = False
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; a repeated row stays once."""
    found = exact_duplicates(docs, id, text, largest).where("kept")
    keys = [F.col("__id").eqNullSafe(F.col("doc_id_kept")), F.col("__sha") == F.col("sha_kept")]
    own = docs.withColumns({
        "__id": F.col(f"`{id}`"), "__sha": F.sha2(lower_ascii(text_of(text)), 256)})
    stays = own.join(
        found.select(F.col("doc_id").alias("doc_id_kept"), F.col("text_sha256").alias("sha_kept"),
                     F.col("n_rows").alias("__n")), keys).drop("doc_id_kept", "sha_kept")
    once = stays.where("__n = 1")
    again = stays.where("__n > 1").dropDuplicates(["__id", "__sha"])
    return once.unionByName(again).select(*[F.col(f"`{c}`") for c in docs.columns])
