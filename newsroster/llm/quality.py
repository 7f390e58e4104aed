"""Quality rules: text measures, and a hashed n-gram likelihood ratio against trusted text."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import constant_array, sampled_ids, text_of, words

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"


def word_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(w))


def n_grams(hashes: Column, buckets: int) -> Column:
    """Buckets (a power of two) of all single words and all pairs of neighbours."""
    mask = F.lit(buckets - 1).cast("long")
    one = F.transform(hashes, lambda h: h.bitwiseAND(mask))
    two = F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)).bitwiseAND(mask))
    return F.concat(one, two)


def ratio_table(
    docs: DataFrame, trusted: DataFrame, id: str = "doc_id", text: str = "text",
    buckets: int = 1 << 14, most_trusted: int = 20_000, prior: float = 1.0,
) -> list[float]:
    """log P(bucket | trusted text) - log P(bucket | whole corpus), for each bucket.

    The corpus side counts the n-grams of every text of ``docs``. The trusted side counts those
    of at most ``most_trusted`` documents whose id is in ``trusted`` (column ``doc_id``), chosen
    by hash; that bound is what allows their ids to be broadcast. Both counts have ``prior``
    added. Without trusted documents all ratios are 0. The driver gets ``buckets`` numbers.
    """
    chosen = sampled_ids(trusted, "doc_id", most_trusted, "trusted")
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), word_hashes(words(text_of(text))).alias("hw")).join(
        F.broadcast(chosen.withColumn("is_trusted", F.lit(1))), "id", "left")
    counts = (
        rows.select(F.explode(n_grams(F.col("hw"), buckets)).alias("b"), "is_trusted")
        .groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("is_trusted").alias("good")))
    raw, good = [prior] * buckets, [prior] * buckets
    for b, n, m in counts.collect():
        raw[b] += n
        good[b] += m
    if sum(good) == prior * buckets:
        return [0.0] * buckets
    shift = math.log(sum(raw)) - math.log(sum(good))
    return [math.log(g) - math.log(r) + shift for g, r in zip(good, raw)]


def _windows(hashes: Column) -> Column:
    return F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)))


def _starts(ordered: Column) -> Column:
    """Places of the windows that have an equal neighbour in the sorted order."""
    twice = F.filter(ordered, lambda x, i: (
        (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"])))
    return F.transform(twice, lambda x: x["i"])


def measures(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, hw`` (word hashes) and the text measures of every row.

    ``n_repeat_words`` counts the words that lie in a 3-word window found twice or more, each
    word once. Windows are sorted by hash to find equal neighbours, never compared all with all,
    and texts without a repeated window skip the sort.
    """
    t, none = F.col("t"), F.array().cast("array<int>")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    own = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    return (
        docs.select(F.col(f"`{id}`").alias("doc_id"), text_of(text).alias("t"))
        .select(
            "doc_id", words(t).alias("w"), lines.alias("lines"),
            F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"))
        .select(
            "doc_id", F.size("w").cast("long").alias("n_words"),
            F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols",
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            word_hashes(F.col("w")).alias("hw"))
        .select(*own, "hw", _windows(F.col("hw")).alias("h"))
        .select(*own, "hw", "h", F.size(F.array_distinct("h")).alias("n_distinct"))
        .select(*own, "hw", F.when(F.size("h") > F.col("n_distinct"), F.sort_array(F.transform(
            "h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ordered"))
        .select(*own, "hw", F.coalesce(F.when(
            F.col("ordered").isNotNull(), _starts(F.col("ordered"))), none).alias("at"))
        .select(*own, "hw", F.size(F.array_distinct(F.concat(
            "at", F.transform("at", lambda i: i + 1), F.transform("at", lambda i: i + 2))))
            .cast("long").alias("n_repeat_words")))


def judge(
    docs: DataFrame, trusted: DataFrame, id: str = "doc_id", text: str = "text",
    least_ratio: float = -0.08, buckets: int = 1 << 14, most_trusted: int = 20_000,
) -> DataFrame:
    """Measures and verdict of every row of ``docs``.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    ratio, kept``. ``ratio`` is the mean log-likelihood ratio of the text's hashed n-grams
    (:func:`ratio_table`), so length does not count; a text stays if it has not failed the base
    rules and its ratio is ``least_ratio`` or more, without any drawing by chance. Null texts
    have no words (ratio 0) and fail the base rules. Repeated rows and null ids are judged row
    by row; other columns are ignored; an empty table gives an empty result.

    Two passes over the texts: counting, with partial sums in each task, and judging, which
    needs no shuffle at all.
    """
    table = constant_array(ratio_table(docs, trusted, id, text, buckets, most_trusted))
    measured = measures(docs, id, text).withColumn("grams", n_grams(F.col("hw"), buckets))
    total = F.aggregate("grams", F.lit(0.0), lambda sum_, b: sum_ + F.get(table, b))
    scored = measured.withColumn("ratio", F.when(
        F.size("grams") > 0, total / F.size("grams")).otherwise(0.0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "ratio",
        (~failed & (F.col("ratio") >= least_ratio)).alias("kept"))
