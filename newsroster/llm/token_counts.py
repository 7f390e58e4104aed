"""Token counts: best unigram segmentations over a trie of distinct pre-tokens."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .pieces import TokenNumbers, Vocabulary, new_depth, slices
from .workers import worker_state


MOST_KNOWN = 150_000  # pre-tokens that a worker remembers between slices


class TrieCounts:
    """Piece counts of pre-tokens, computed in sorted order so that a shared prefix is computed
    once: the path from the root to the current trie node is kept as a stack of best scores.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.known = vocabulary.by_suffix()
        self.byte_log_p = vocabulary.byte_log_p
        self.numbers, self.counts = TokenNumbers(), np.zeros(0, np.int64)

    def best(self, tokens: list[str]) -> list[int]:
        """Number of pieces of the most probable segmentation of every token; sorted input
        shares most. Of equally probable last pieces the longest counts."""
        known, found = self.known, []
        scores, counts, previous = [0.0], [0], ""
        for token in tokens:
            depth = new_depth(previous, token)
            del scores[depth + 1:], counts[depth + 1:]
            for end in range(depth + 1, len(token) + 1):
                start = end - 1
                piece = token[start]
                p = known.get(piece)
                if p is None:  # its bytes
                    n = len(piece.encode("utf-8", "surrogatepass"))
                    best, pieces = scores[start] + n * self.byte_log_p, counts[start] + n
                else:
                    best, pieces = scores[start] + p, counts[start] + 1
                while start and piece in known:
                    start -= 1
                    piece = token[start:end]
                    p = known.get(piece)
                    if p is not None and scores[start] + p >= best:
                        best, pieces = scores[start] + p, counts[start] + 1
                scores.append(best)
                counts.append(pieces)
            found.append(counts[-1])
            previous = token
        return found

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Piece counts of texts; only pre-tokens not met before go through the trie."""
        if self.numbers.count > MOST_KNOWN:
            self.numbers.clear()
            self.counts = self.counts[:0]
        found, sizes = self.numbers(texts)
        fresh = self.numbers.take_fresh()
        order = sorted(range(len(fresh)), key=fresh.__getitem__)
        counts = np.zeros(len(fresh), np.int64)
        counts[order] = self.best([fresh[k] for k in order])
        self.counts = np.concatenate([self.counts, counts])
        sums = np.concatenate([[0], np.cumsum(self.counts[found])])
        ends = np.cumsum(sizes)
        return sums[ends] - sums[ends - sizes]


def token_count(spark: SparkSession, text: Column, model_path: str | None = None) -> Column:
    """Number of pieces of the most probable segmentation of a text; null and empty texts have 0.

    Pieces and probabilities are those of :class:`Vocabulary` (by default the public 32k model;
    the file is read on the driver). Each task collects the distinct pre-tokens of a slice of its
    rows (500,000 characters, or one longer text), walks them in sorted order as a trie, and
    adds up the counts stored at their ends. It keeps the counts of at most
    150,000 of them for later slices.
    No shuffle, and rows do not depend on each other: ties, repeated rows and hot keys change
    nothing.
    """
    shared, key = spark.sparkContext.broadcast(Vocabulary.load(model_path)), uuid.uuid4().hex

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        count = worker_state(key, lambda: TrieCounts(shared.value))
        lengths = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
        parts = [count(texts.slice(begin, end - begin).to_pylist())
                 for begin, end in slices(lengths)]
        return pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))

    return counted(text)


def with_token_counts(
    docs: DataFrame, text: str = "text", name: str = "n_tokens", model_path: str | None = None
) -> DataFrame:
    """``docs`` with the column ``name`` added (or replaced); all else stays as it is."""
    return docs.withColumn(name, token_count(
        docs.sparkSession, F.col(f"`{text}`").cast("string"), model_path))
