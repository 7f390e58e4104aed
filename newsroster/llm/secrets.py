"""Secret scans: fixed patterns, and Markov models that tell random strings from identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from .common import constant_array, sampled_ids, text_of

# The base kinds in their order, each with pattern, value group and least length.
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
               r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),  # a run too short fails as a whole
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
ADDED = "random"
# Runs that may be secrets, and runs that count as ordinary identifiers in training.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9_]{6,}"
# Characters the models know, in either case; any other is one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SIDE = len(ALPHABET) + 1

SPANS = "array<struct<start:int, kind:int, end:int, value:string>>"
SCAN_STEPS = 31  # doubling steps of a prefix scan: arrays up to 2^31 elements


def _scan(values: Column, combine) -> Column:
    """Inclusive prefix scan of an array by doubling: step k combines each element with the one
    2^k before it. Linear in the array (a fixed 31 passes), where growing an array is quadratic."""
    def step(gap: int):  # a lambda with a default argument would be taken for one with an index
        return lambda a: F.transform(a, lambda x, i: F.when(i >= gap, combine(F.get(a, i - gap), x)).otherwise(x))

    out = values
    for k in range(SCAN_STEPS):
        out = let(out, step(1 << k))
    return out


def _found(t: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches with their places in code points, short ones dropped.

    A place is the summed length of all gaps and matches before it.
    """
    pairs = F.zip_with(
        F.split(t, pattern, -1), F.arrays_zip(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("all"),
            F.regexp_extract_all(t, F.lit(pattern), F.lit(group)).alias("value")),
        lambda gap, hit: F.struct(
            F.length(gap).alias("gap"), F.length(hit["all"]).alias("n"), hit["value"].alias("value")))

    def placed(hits: Column) -> Column:
        ends = _scan(F.transform(hits, lambda p: p["gap"] + p["n"]), lambda a, b: a + b)
        return let(ends, lambda e: F.zip_with(hits, e, lambda p, end: F.struct(
            (end - p["n"]).alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
            p["value"].alias("value"))))

    spans = let(F.filter(pairs, lambda p: p["n"].isNotNull()), placed)
    return F.when(t.rlike(pattern), F.filter(spans, lambda s: F.length(s["value"]) >= least)) \
        .otherwise(F.array().cast(SPANS))


def base_spans(t: Column) -> Column:
    """All base matches of a text as spans ``start, kind, end, value``, by kind."""
    return F.concat(*[_found(t, k, *BASE[name]) for k, name in enumerate(BASE)])


def _steps(run: Column) -> Column:
    """Pairs of neighbouring characters as numbers below SIDE * SIDE."""
    def code(c):
        return F.instr(F.lit(ALPHABET), c)

    def pairs(chars: Column) -> Column:
        n = F.greatest(F.size(chars) - 1, F.lit(0))
        return F.zip_with(F.slice(chars, 1, n), F.slice(chars, 2, n), lambda a, b: code(a) * SIDE + code(b))

    return let(F.split(F.lower(run), ""), pairs)


def ratio_table(
    docs: DataFrame, id: str = "doc_id", text: str = "text", most: int = 20_000,
    prior: float = 0.5,
) -> list[float]:
    """log P(next | character, random string) - log P(next | character, identifier), flat.

    Trained on the texts of at most ``most`` documents chosen by hash (the bound of this
    sample). Labels come from the base rules: values they match are random strings, other runs
    of six or more letters, digits and underscores are identifiers. ``prior`` is added to each
    count. Without examples of both kinds all ratios are 0. The driver gets two small tables.
    """
    t = F.col("t")
    sample = docs.select(F.col(f"`{id}`").alias("id"), text_of(text).alias("t")).join(
        F.broadcast(sampled_ids(docs, id, most, "secrets")), "id")
    plain = t
    for pattern, _, _ in BASE.values():
        plain = F.regexp_replace(plain, pattern, " ")
    runs = sample.select(
        F.transform(base_spans(t), lambda s: s["value"]).alias("secret"),
        F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0)).alias("plain"))
    counts = [[prior] * (SIDE * SIDE) for _ in range(2)]
    for k, name in enumerate(("secret", "plain")):
        steps = runs.select(F.explode(name).alias("run")).select(
            F.explode(_steps(F.col("run"))).alias("step"))
        found = steps.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()
        if not found:
            return [0.0] * (SIDE * SIDE)
        for step, n in found:
            counts[k][step] += n

    def logs(table):
        rows = [table[i:i + SIDE] for i in range(0, len(table), SIDE)]
        return [math.log(n) - math.log(sum(row)) for row in rows for n in row]

    return [a - b for a, b in zip(*map(logs, counts))]


def find_secrets(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_ratio: float = 0.5,
    most: int = 20_000,
) -> DataFrame:
    """Secrets in every row: ``doc_id, spans``, ``spans`` an array of ``start, end, kind, value``.

    Places are code points, the end exclusive. All base matches are in it, and as kind
    ``random`` those runs of 20 or more of ``A-Za-z0-9+/_=-`` that no base match touches and
    whose mean log-likelihood ratio per step (:func:`ratio_table`) is ``least_ratio`` or more.
    Spans come by start, then kind. Null and empty texts have none. Repeated rows and null ids
    are scanned row by row; other columns are ignored; an empty table gives an empty result.

    One pass and no shuffle after training; texts that a pattern does not occur in are not cut
    up for it.
    """
    table = constant_array(ratio_table(docs, id, text, most))
    t, base = F.col("t"), F.col("base")

    def is_random(span):
        steps = _steps(span["value"])
        total = F.aggregate(steps, F.lit(0.0), lambda sum_, s: sum_ + F.get(table, s))
        return total >= least_ratio * F.size(steps)

    def new_ones(base: Column, candidates: Column) -> Column:
        """Candidates that no base span touches, by one merge: events sorted by place, a base span
        at its start (after a candidate ending there), a candidate at its end; a running maximum of
        base ends tells whether a base span that starts before a candidate's end reaches past its start."""
        events = F.array_sort(F.concat(
            F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("kind"),
                                                 b["end"].alias("reach"), F.lit(-1).alias("index"))),
            F.transform(candidates, lambda c, i: F.struct(c["end"].alias("at"), F.lit(0).alias("kind"),
                                                          F.lit(-1).alias("reach"), i.alias("index")))))
        reach = let(events, lambda ev: F.zip_with(ev, _scan(F.transform(ev, lambda e: e["reach"]), F.greatest),
                                                  lambda e, most: F.struct(e["index"].alias("index"),
                                                                           most.alias("most"))))
        free = F.transform(F.filter(reach, lambda r: r["index"] >= 0), lambda r: F.struct(
            r["index"].alias("index"), r["most"].alias("most")))
        return F.filter(F.transform(free, lambda r: F.struct(
            F.get(candidates, r["index"]).alias("span"), r["most"].alias("most"))),
            lambda r: r["most"] <= r["span"]["start"])

    names = F.array(*[F.lit(name) for name in [*BASE, ADDED]])
    found = (
        docs.select(F.col(f"`{id}`").alias("doc_id"), text_of(text).alias("t"))
        .select("doc_id", base_spans(t).alias("base"),
                _found(t, len(BASE), CANDIDATE, 0, 20).alias("candidates"))
        .select("doc_id", F.concat("base", F.filter(F.transform(
            new_ones(base, F.col("candidates")), lambda r: r["span"]), is_random)).alias("spans")))
    return found.select("doc_id", F.transform(F.sort_array("spans"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind"),
        s["value"].alias("value"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as one string."""
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != ADDED)
    counts = [count(kind) for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))
