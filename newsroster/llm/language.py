"""Language identification by prediction by partial matching."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .pieces import slices
from .workers import in_slices, worker_state

ORDER = 3  # bytes of context at most
PAD = b"\n" * ORDER  # context before the first byte
def has_letter(text: str) -> bool:
    """A letter is a character of Unicode category L (``str.isalpha``); numbers such as ½, ² or Ⅷ are not."""
    return any(ch.isalpha() for ch in text)
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Frozen context trees of all languages, laid over each other.

    ``contexts`` has the known contexts of 1 to 3 bytes; state 0 is the empty one. ``bits`` has
    the exact code length of each byte class in each state, per language: a byte seen after the
    state's context costs its share there; otherwise the escape probability and what the byte
    costs after the context that is one byte shorter, down to 8 bits for a byte never seen.
    Bytes in no training text share class 0.
    """

    languages: tuple[str, ...]
    contexts: tuple[bytes, ...]
    classes: np.ndarray  # of each byte
    bits: np.ndarray  # state x class x language

    @staticmethod
    def from_counts(counts: dict[str, dict[bytes, int]], most_contexts: int) -> LanguageModel:
        """From counts of 4-byte strings per language, on the driver. Contexts seen once are left
        out, and beyond ``most_contexts`` the rarest."""
        languages = tuple(sorted(counts))
        following: dict[bytes, dict[str, dict[int, int]]] = {}
        for language, grams in counts.items():
            for gram, n in grams.items():
                for k in range(ORDER + 1):
                    seen = following.setdefault(gram[k:ORDER], {}).setdefault(language, {})
                    seen[gram[ORDER]] = seen.get(gram[ORDER], 0) + n
        total = {c: sum(sum(s.values()) for s in by.values()) for c, by in following.items() if c}
        often = sorted((c for c in total if total[c] > 1), key=lambda c: (-total[c], c))
        kept = set(often[:most_contexts])
        # A context needs its shorter ones; those are at least as frequent.
        contexts = tuple(sorted((c for c in kept if c[1:] in kept or len(c) == 1),
                                key=lambda c: (len(c), c)))
        used = sorted({b for by in following.get(b"", {}).values() for b in by})
        classes = np.zeros(256, np.int64)
        classes[used] = np.arange(1, len(used) + 1)
        bits = np.empty((len(contexts) + 1, len(used) + 1, len(languages)))
        number = {c: k for k, c in enumerate(contexts, 1)}
        for context, state in [(b"", 0), *number.items()]:
            shorter = number.get(context[1:], 0)
            for k, language in enumerate(languages):
                below = bits[shorter, :, k] if state else np.full(len(used) + 1, 8.0)
                seen = following.get(context, {}).get(language)
                if not seen:
                    bits[state, :, k] = below
                    continue
                whole = sum(seen.values()) + len(seen)
                bits[state, :, k] = below - np.log2(len(seen) / whole)
                for b, n in seen.items():
                    bits[state, classes[b], k] = -np.log2(n / whole)
        return LanguageModel(languages, contexts, classes, bits.astype(np.float32))

    def states(self) -> np.ndarray:
        """The state after any three bytes: that of the longest known context."""
        table = np.zeros((256, 256, 256), np.min_scalar_type(len(self.contexts)))
        for state, context in enumerate(self.contexts, 1):  # short ones first
            table[(Ellipsis, *context)] = state
        return table.reshape(-1)


class Scorer:
    """Code lengths of texts, many positions at a time."""

    def __init__(self, model: LanguageModel):
        self.model, self.table = model, model.states()
        self.n_classes = model.bits.shape[1]
        self.bits = model.bits.reshape(model.bits.shape[0] * self.n_classes, -1) \
            if model.languages else None

    def __call__(self, texts: list[bytes], most: int = 250_000) -> np.ndarray:
        """Bits of each text (row) in each language; long texts go through in pieces."""
        totals = np.zeros((len(texts), len(self.model.languages)))
        for begin, end in slices([len(t) for t in texts], most):
            joined = PAD + PAD.join(texts[begin:end])
            codes = np.frombuffer(joined, np.uint8)
            sizes = np.array([len(t) for t in texts[begin:end]], np.int64)
            starts = np.cumsum(sizes + ORDER) - sizes
            for low in range(ORDER, len(codes), most):
                high = min(low + most, len(codes))
                wide = codes[low - ORDER:high].astype(np.int32)
                state = self.table[(wide[:-3] << 16) | (wide[1:-2] << 8) | wide[2:-1]]
                cost = self.bits[state * np.int64(self.n_classes) + self.model.classes[codes[low:high]]]
                inside = (starts < high) & (starts + sizes > low) & (sizes > 0)
                edges = np.stack([np.maximum(starts[inside], low),
                                  np.minimum(starts[inside] + sizes[inside], high)], 1) - low
                # Sums between pairs of edges; what lies between texts is left out.
                cost = np.concatenate([cost, np.zeros((1, cost.shape[1]), np.float32)])
                totals[begin:end][inside] += np.add.reduceat(
                    cost, edges.reshape(-1), axis=0, dtype=np.float64)[::2]
        return totals


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang, gram, n``: 4-byte strings (as a number) of the column ``t``, by language."""
    @F.arrow_udf("array<struct<gram:bigint,n:bigint>>")
    def counted(texts: pa.Array) -> pa.Array:
        result = []
        for text in texts.to_pylist():
            codes = np.frombuffer(PAD + text.encode(), np.uint8).astype(np.int64)
            grams, n = np.unique((codes[:-3] << 24) | (codes[1:-2] << 16) | (codes[2:-1] << 8)
                                 | codes[3:], return_counts=True)
            result.append([{"gram": g, "n": m} for g, m in zip(grams.tolist(), n.tolist())])
        return pa.array(result, pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))

    return rows.select("lang", F.explode(counted(F.col("t"))).alias("x")).groupBy(
        "lang", "x.gram").agg(F.sum("x.n").alias("n"))


def train(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = 400, most_languages: int = 200, most_grams: int = 50_000,
    most_contexts: int = 20_000,
) -> LanguageModel:
    """Learn from a bounded sample of labelled rows.

    The sample: of each of the ``most_languages`` most frequent labels the ``per_language``
    documents whose ids have the smallest hashes, whole texts. Rows with a null label, text or id
    teach nothing. Their 4-byte strings are counted by tasks; of each language the ``most_grams``
    most frequent go to the driver, which builds the trees.
    """
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"),
        F.col(f"`{lang}`").cast("string").alias("lang")).dropna()
    labels = [r[0] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
              .limit(most_languages).collect()]
    if not labels:
        return LanguageModel.from_counts({}, most_contexts)
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("language"), "id"), "id")
    chosen = (
        rows.where(F.col("lang").isin(labels)).select("lang", "id")
        .withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)
        .select("lang", "id").distinct())
    # At most per_language * most_languages ids.
    counts = gram_counts(rows.join(F.broadcast(chosen), ["lang", "id"], "left_semi"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = counts.withColumn("k", F.row_number().over(by_count)).where(F.col("k") <= most_grams)
    found: dict[str, dict[bytes, int]] = {}
    for label, gram, n in counts.select("lang", "gram", "n").collect():
        found.setdefault(label, {})[gram.to_bytes(4, "big")] = n
    return LanguageModel.from_counts(found, most_contexts)


def identify(spark: SparkSession, text: Column, model: LanguageModel) -> Column:
    """A struct ``lang_pred, score, bits_per_byte`` for each text.

    The language whose model gives the shortest code; equal lengths go to the first by code
    point. ``score`` is its probability if all languages are equally likely before. Texts that
    are null or have no letter get ``und`` and 0, and so does all if nothing was learned.
    """
    shared, run = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()),
                      ("bits_per_byte", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double,bits_per_byte:double>")
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = worker_state(run, lambda: Scorer(shared.value))
        languages = scorer.model.languages
        for texts, in in_slices(batches, pc.binary_length):
            part = texts.to_pylist()
            known = np.array([bool(languages and t and has_letter(t)) for t in part])
            raw = [t.encode("utf-8", "replace") if ok else b"" for t, ok in zip(part, known)]
            if not languages:
                bits = np.zeros((len(part), 1))
            else:
                bits = scorer(raw)
            best = bits.argmin(1)
            least = bits[np.arange(len(part)), best]
            share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
            names = [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known)]
            rates = np.where(known, least / np.maximum(1, [len(r) for r in raw]), 0.0)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0)), pa.array(rates)],
                fields=list(kind))

    # Said to be nondeterministic only to keep the optimizer from running it once per use.
    return identified.asNondeterministic()(text)


def with_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "language"
) -> DataFrame:
    """``docs`` with the struct of :func:`identify` added as ``name``: row by row, no shuffle, so
    repeated rows, ties and extra columns change nothing and an empty table stays empty."""
    return docs.withColumn(name, identify(
        docs.sparkSession, F.col(f"`{text}`").cast("string"), model))
