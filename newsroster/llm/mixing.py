"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import text_of, words

BINS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source, source_size`` plus ``target``, from one row per source.

    All targets add up to all sizes. Sources by code point, null last, weigh ``weights`` in
    turn. A target above ``most`` times its source's size is cut to that, and the rest shared
    anew by weight. With sources ordered by size over weight, the cut ones come first, and the
    level (words per unit of weight) that holds in the end is the highest that any number of
    leading cuts gives; so running sums replace repeated rounds. The windows hold one row per
    source, never documents.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    order = (F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    rest = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        weighted.withColumn("cap", most * F.col("source_size"))
        .withColumn("left", F.sum("source_size").over(everything)
                    - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("share", F.sum("weight").over(rest)))
    best = F.max(F.struct(F.col("left") / F.col("share"), "left", "share")).over(everything)
    return levels.withColumn("best", best).select(
        "source", "source_size", "n_sized", "odds_base",
        F.least(F.col("cap").cast("double"),
                F.col("best.left") * F.col("weight") / F.col("best.share")).alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    most: int = 3,
    salt: str = "mix",
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often the mix takes each document.

    Returns ``doc_id, size, source_size, target, copies, taken`` for every row. ``size`` is the
    number of words (null: 0), ``taken`` is ``copies * size``. Of a source whose target is t
    times its size, every document is taken floor(t) times for certain. What is missing then is
    drawn without replacement: a document's inclusion probability p is proportional to
    max(1, floor(sqrt(size))) and averages the missing share; documents are ranked by
    u/(1-u) * (1-p)/p, u from a hash of ``salt`` and id, and taken from the front while the
    middle of the document lies within the missing words. p of 1 or more ranks first. So a
    source misses its target by half a document at most, and no document exceeds ``most``
    copies; runs agree.

    Null source is a source of its own; a null id hashes as ``null``; rows that repeat an id are
    documents with the same u, ordered by size. Documents without words get 0 copies. An empty
    table gives an empty result; other columns are ignored.

    Texts are read once; what is kept of them is three short columns. The place where a source
    stops is found from its word counts in 4096 rank bins, and only documents of the bin it
    falls in are sorted, so a source with a third of all rows needs no task of its own.
    """
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(salt + ":"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") + 0.5) \
        / F.lit(float(1 << 52))
    sized = cut_lineage(docs.select(
        F.col(f"`{id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        F.size(words(text_of(text))).cast("long").alias("size")))
    sized = sized.withColumn("odds", F.when(
        F.col("size") > 0, F.greatest(F.lit(1), F.floor(F.sqrt("size"))).cast("long")))
    sources = source_targets(
        sized.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count("odds").alias("n_sized"),
            F.sum("odds").alias("odds_base")), weights, most)
    sources = cut_lineage(
        sources.withColumn("whole", F.when(
            F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "of"))
    drawn = (F.col("size") > 0) & (F.col("missing") > 0)
    p = F.when(drawn, F.least(F.lit(1.0), F.col("missing") / F.col("source_size") * F.col("odds")
                              * F.col("n_sized") / F.col("odds_base")))
    ranked = (
        sized.join(sources, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("p", p).withColumn("u", u)
        .withColumn("q", F.when(F.col("p") >= 1, 0.0).when(
            F.col("p") > 0, F.col("u") / (1 - F.col("u")) * ((1 - F.col("p")) / F.col("p"))))
        .withColumn("place", F.col("q") / (1 + F.col("q")))
        .withColumn("bin", F.least(F.floor(F.col("place") * BINS), F.lit(BINS - 1))))
    bins = ranked.where("bin is not null").groupBy("of", "bin").agg(
        F.sum("size").alias("n"), F.first("missing").alias("missing"))
    upto = Window.partitionBy("of").orderBy("bin")
    ends = (
        bins.withColumn("after", F.sum("n").over(upto))
        .where((F.col("after") - F.col("n") <= F.col("missing")) & (F.col("missing") < F.col("after")))
        .select(F.col("of").alias("end_of"), F.col("bin").alias("end_bin"),
                (F.col("after") - F.col("n")).alias("base")))
    placed = ranked.join(ends, F.col("of").eqNullSafe(F.col("end_of")), "left")
    inside = F.coalesce(F.col("bin") == F.col("end_bin"), F.lit(False))
    # No end: all that is missing fits.
    one = placed.where(~inside).withColumn("more", F.coalesce(
        F.col("bin") < F.coalesce(F.col("end_bin"), F.lit(BINS)), F.lit(False)).cast("long"))
    within = Window.partitionBy("of").orderBy("place", F.asc_nulls_last("doc_id"), "size")
    running = F.col("base") + F.sum("size").over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    two = placed.where(inside).withColumn(
        "more", (2 * running + F.col("size") <= 2 * F.col("missing")).cast("long"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("more")).otherwise(0).cast("long")
    return one.unionByName(two).select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that the mix takes, each as often as it does, with all columns of ``docs``. Rows
    that repeat an id are taken as often as the one of them that is taken most."""
    copies = mix(docs, id=id, text=text, **options).groupBy(F.col("doc_id").alias("__of")).agg(
        F.max("copies").alias("__copies")).where("__copies > 0")
    taken = docs.join(copies, F.col(f"`{id}`").eqNullSafe(F.col("__of")))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
