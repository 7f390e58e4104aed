"""Sampled sentencepiece encoding and lossless decoding."""

from __future__ import annotations

import math
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .pieces import TokenNumbers, Vocabulary
from .workers import in_slices, worker_state

MOST_NODES = 150_000  # lattice nodes that a worker remembers between batches
LONG = 64  # longer pre-tokens share no prefixes, so that their scores can be rescaled
MOST_TOKENS = 8_192  # pre-tokens whose lattices are built at a time
MOST_PIECES = 250_000  # pieces that are decoded at a time, or one longer text
TINY, SCALE = 1e-200, 1e200


class Lattices:
    """Forward-filtered piece lattices of pre-tokens, on a trie.

    A node is a prefix. Its entering edges are the pieces that end there, short ones first; an
    edge has the forward weight of all segmentations that end with its piece. Node 0 is the root.
    An edge's code is the piece id, or -1 - c where character c is written as its bytes.
    """

    def __init__(self, vocabulary: Vocabulary, temper: float):
        known = vocabulary.by_suffix()
        weight = {p: math.exp(temper * x) for p, x in known.items() if x is not None}
        self.byte_weight = math.exp(temper * vocabulary.byte_log_p)
        self.byte_weights = np.array([self.byte_weight ** n for n in range(5)])
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)
        # The suffixes of pieces as a trie that is read backwards: a state per suffix, 0 for none.
        order = sorted(known, key=len)
        state = {p: k for k, p in enumerate(order, 1)}
        self.weights, self.ids = np.zeros(len(order) + 1), np.full(len(order) + 1, -1, np.int32)
        for p, w in weight.items():
            self.weights[state[p]], self.ids[state[p]] = w, vocabulary.ids[p]
        self.steps = np.array([state.get(p[1:], 0) << 21 | ord(p[0]) for p in order], np.int64)
        self.reached = np.argsort(self.steps) + 1
        self.steps.sort()
        self.known = None
        self.vocabulary, self.temper = vocabulary, temper
        self.numbers = TokenNumbers()
        self.clear()

    def clear(self):
        self.numbers.clear()
        self.token_of = []  # pre-tokens by number
        self.uses = np.zeros(0, np.int64)  # slices in which each pre-token occurred
        self.node_of = np.zeros(0, np.int64)  # by number of the pre-token
        self.last = np.full(1, -1, np.int64)  # longest entering edge of each node
        self.below = np.zeros(0)  # share of the shorter edges of the same node
        self.code, self.origin = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def step(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The states after one more character to the left."""
        wanted = states << 21 | chars
        at = np.minimum(np.searchsorted(self.steps, wanted), len(self.steps) - 1)
        return np.where(self.steps[at] == wanted, self.reached[at], 0)

    def extend(self, widths, below, totals, codes, origins):
        self.last = np.concatenate([self.last, len(self.code) + np.cumsum(widths) - 1])
        self.below = np.concatenate([self.below, below / np.repeat(totals, widths)])
        self.code = np.concatenate([self.code, codes])
        self.origin = np.concatenate([self.origin, origins])

    def add(self, tokens: list[str]) -> list[int]:
        """Nodes of tokens; a prefix shared with the token before is reused, so sort them."""
        short = [k for k, token in enumerate(tokens) if len(token) <= LONG]
        ends = np.zeros(len(tokens), np.int64)
        for first in range(0, len(short), MOST_TOKENS):
            part = short[first:first + MOST_TOKENS]
            ends[part] = self.add_short([tokens[k] for k in part])
        for k, token in enumerate(tokens):
            if len(token) > LONG:
                ends[k] = self.add_long(token)
        return ends.tolist()

    def add_short(self, tokens: list[str]) -> np.ndarray:
        """Many tokens at a time: their edges by steps through the trie, their weights by place."""
        sizes = np.array(list(map(len, tokens)), np.int64)
        wide = int(sizes.max())
        joined = "".join(token.ljust(wide, "\0") for token in tokens)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, wide)
        inside = np.arange(wide) < sizes[:, None]
        # Characters shared with the token before; padding counts as different.
        fresh = inside.copy()
        fresh[1:] &= ~np.logical_and.accumulate((chars[1:] == chars[:-1]) & inside[1:] & inside[:-1], axis=1)
        row, place = np.nonzero(fresh)
        base, n = len(self.last), len(row)
        path = np.zeros((len(tokens), wide + 1), np.int32)  # the root, then a node per character
        path[row, place + 1] = np.arange(base, base + n)
        np.maximum.accumulate(path, axis=0, out=path)

        nodes, at, states = [], np.arange(n), np.zeros(n, np.int64)
        for k in range(wide):  # the edge of k + 1 characters
            start = place[at] - k
            char = chars[row[at], start].astype(np.int64)
            states = self.step(states, char)
            ids = self.ids[states]
            edge = ids >= 0
            code, weight = ids, self.weights[states]
            if not k:
                code = np.where(edge, ids, -1 - char)
                weight = np.where(edge, weight, self.byte_weights[
                    1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF)])
                edge = np.ones(n, bool)
            nodes.append((at[edge], code[edge], weight[edge], path[row[at[edge]], start[edge]]))
            on = (states > 0) & (start > 0)
            at, states = at[on], states[on]
            if not len(at):
                break
        node, code, weight, origin = map(np.concatenate, zip(*nodes))
        order = np.argsort(node, kind="stable")  # by node, short edges first
        node, code, weight, origin = node[order], code[order], weight[order], origin[order]
        widths = np.bincount(node, minlength=n)
        firsts = np.cumsum(widths) - widths

        # What a node gets lies at lower places of its token; its edges are summed in order.
        totals, below = np.zeros(n), np.zeros(len(node))
        forward = np.ones(n + 1)  # of the root, then of the nodes made here
        by_place = np.argsort(place, kind="stable")
        for own in np.split(by_place, np.cumsum(np.bincount(place, minlength=wide))[:-1]):
            k, sums = 0, np.zeros(len(own))
            live = np.arange(len(own))
            while len(live):
                edge = firsts[own[live]] + k
                below[edge] = sums[live]
                sums[live] += forward[np.maximum(origin[edge] - base + 1, 0)] * weight[edge]
                k += 1
                live = live[widths[own[live]] > k]
            totals[own] = sums
            forward[own + 1] = sums
        self.extend(widths, below, totals, code.astype(np.int32), origin)
        return path[np.arange(len(tokens)), sizes].astype(np.int64)

    def add_long(self, token: str) -> int:
        """One token, its weights rescaled on the way."""
        if self.known is None:
            self.known = {
                p: None if x is None else (math.exp(self.temper * x), self.vocabulary.ids[p])
                for p, x in self.vocabulary.by_suffix().items()}
        known = self.known
        totals, below, widths = array("d"), array("d"), array("i")
        codes, origins = array("i"), array("i")
        node = len(self.last)
        forward, path = [1.0], [0]
        for end in range(1, len(token) + 1):
            first = len(codes)
            start = end - 1
            piece = token[start]
            entry = known.get(piece)
            if entry is None:
                n = len(piece.encode("utf-8", "surrogatepass"))
                entry = self.byte_weight ** n, -1 - ord(piece)
            below.append(0.0)
            codes.append(entry[1])
            origins.append(path[start])
            total = forward[start] * entry[0]
            while start and piece in known:
                start -= 1
                piece = token[start:end]
                entry = known.get(piece)
                if entry is not None:
                    below.append(total)
                    codes.append(entry[1])
                    origins.append(path[start])
                    total += forward[start] * entry[0]
            totals.append(total)
            widths.append(len(codes) - first)
            forward.append(total)
            path.append(node)
            node += 1
            if total < TINY:
                forward[-17:] = [x * SCALE for x in forward[-17:]]
        self.extend(np.array(widths, np.int64), np.array(below), totals,
                    np.array(codes, np.int32), np.array(origins, np.int32))
        return path[-1]

    def renew(self):
        """Start again with room, keeping the pre-tokens that came back: those of two or more
        slices, most used first, up to half of ``MOST_NODES`` characters. They are numbered anew
        and built with the next slice; a pre-token's lattice and draws do not depend on its number."""
        frequent = np.flatnonzero(self.uses >= 2)
        frequent = frequent[np.argsort(-self.uses[frequent], kind="stable")]
        kept, room = [], MOST_NODES // 2
        for number in frequent.tolist():
            token = self.token_of[number]
            if len(token) > room:
                break
            room -= len(token)
            kept.append((token, int(self.uses[number])))
        self.clear()
        numbers, uses = self.numbers, {}
        for token, used in kept:
            if token == "\n":
                uses[0] = used
            elif token.startswith(" "):
                uses[numbers.spaced[token[1:]]] = used
            else:
                uses[numbers.bare[token]] = used
        self.uses = np.zeros(numbers.count, np.int64)
        self.uses[list(uses)] = list(uses.values())

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Last nodes of the pre-tokens of all texts, and how many each text has."""
        if len(self.last) > MOST_NODES:
            self.renew()
        found, sizes = self.numbers(texts)
        fresh = self.numbers.take_fresh()
        self.token_of.extend(fresh)  # numbers are given in this order
        self.uses = np.concatenate([self.uses, np.zeros(self.numbers.count - len(self.uses), np.int64)])
        self.uses[np.unique(found)] += 1
        order = sorted(range(len(fresh)), key=fresh.__getitem__)
        nodes = np.zeros(len(fresh), np.int64)
        nodes[order] = self.add([fresh[k] for k in order])
        self.node_of = np.concatenate([self.node_of, nodes])
        return self.node_of[found], sizes


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: equal inputs give equal, unrelated inputs unrelated numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


STEP = np.uint64(0x9E3779B97F4A7C15)


def sample(lattices: Lattices, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw a segmentation of each pre-token backwards from its last node.

    ``seeds`` has a number per pre-token. Returns all piece ids and how many each one got.
    """
    at = np.arange(len(nodes))
    node, counts, drawn, step = nodes, np.zeros(len(nodes), np.int64), [], 0
    while len(at):
        step += 1
        u = (mixed(seeds[at] + np.uint64(step * int(STEP) % (1 << 64))) >> np.uint64(11)) * (1.0 / (1 << 53))
        edge = lattices.last[node]  # mostly the long pieces are the likely ones
        other = np.flatnonzero(lattices.below[edge] > u)
        while len(other):
            edge[other] -= 1
            other = other[lattices.below[edge[other]] > u[other]]
        code = lattices.code[edge]
        width = np.ones(len(at), np.int64)
        char = -1 - code.astype(np.int64)
        wide = code < 0
        width[wide] += (char[wide] > 0x7F).astype(np.int64) + (char[wide] > 0x7FF) + (char[wide] > 0xFFFF)
        counts[at] += width
        drawn.append((at, code, width))
        node = lattices.origin[edge]
        on = np.flatnonzero(node)
        at, node = at[on], node[on]
    place = np.cumsum(counts)
    pieces = np.empty(int(place[-1]) if len(place) else 0, np.int32)
    for at, code, width in drawn:
        place[at] -= width
        plain = code >= 0
        pieces[place[at[plain]]] = code[plain]
        for k in np.flatnonzero(~plain):
            raw = chr(-1 - int(code[k])).encode("utf-8", "surrogatepass")
            pieces[place[at[k]]:place[at[k]] + len(raw)] = lattices.byte_ids[list(raw)]
    return pieces, counts


def encode_batch(lattices: Lattices, keys: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in a row, and how many each text has."""
    nodes, sizes = lattices(texts)
    firsts = np.cumsum(sizes) - sizes
    index = np.arange(len(nodes)) - np.repeat(firsts, sizes)
    row = mixed(np.array(keys, np.int64).astype(np.uint64))
    seeds = mixed(np.repeat(row, sizes) + (index.astype(np.uint64) + np.uint64(1)) * STEP)
    pieces, counts = sample(lattices, nodes, seeds)
    ends = np.concatenate([[0], np.cumsum(counts)])
    return pieces, ends[firsts + sizes] - ends[firsts]


def encoded_slices(lattices: Lattices, batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Piece ids of batches of keys and texts, an array per slice."""
    for keys, texts in in_slices(batches, lambda _, texts: pc.utf8_length(texts)):
        ids, counts = encode_batch(
            lattices, pc.fill_null(keys, 0).to_pylist(), pc.fill_null(texts, "").to_pylist())
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=texts.is_null())


def decoded_slices(table: pa.Array, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts of batches of piece ids, an array per slice."""
    for rows, in in_slices(batches, pc.list_value_length, MOST_PIECES):
        offsets = rows.offsets
        pieces = table.take(rows.values.slice(offsets[0].as_py(), offsets[-1].as_py() - offsets[0].as_py()))
        joined = pc.binary_join(pa.ListArray.from_arrays(
            pc.subtract(offsets, offsets[0]), pieces, mask=rows.is_null()), b"")
        bare = pc.binary_replace_slice(joined, 0, 1, b"")  # without the blank in front
        try:
            yield bare.cast(pa.string())
        except pa.ArrowInvalid:  # not UTF-8
            yield pa.array([x and x.decode("utf-8", "replace") for x in bare.to_pylist()], pa.string())


def encode(spark: SparkSession, key: Column, text: Column, temper: float = 1.0,
           model_path: str | None = None) -> Column:
    """Sampled piece ids of a text, ``array<int>``; null stays null, empty gives an empty array.

    The text gets one blank in front. Its pre-tokens (a run of blanks and what follows, or a line
    break) are segmented independently, as no piece reaches over their starts: forward filtering
    sums the weights of all segmentations of each prefix, and backward sampling draws one in
    proportion to the product of its pieces' probabilities to the power ``temper``. Characters
    without a piece are written as their UTF-8 bytes, also a literal U+2581. Draws depend on
    ``key`` (a long; null counts as 0), the place of the pre-token and nothing else: the same row
    gives the same pieces in any partitioning and on any retry.

    Tasks work on slices of 500,000 characters, or one longer text, and hand over the pieces of
    each; a worker keeps at most 150,000 lattice nodes between slices. No shuffle.
    """
    shared, run = spark.sparkContext.broadcast(Vocabulary.load(model_path)), uuid.uuid4().hex

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return encoded_slices(worker_state(run, lambda: Lattices(shared.value, temper)), batches)

    # Said to be nondeterministic only to keep the optimizer from running it once per use.
    return encoded.asNondeterministic()(key, text)


def decode(spark: SparkSession, ids: Column, model_path: str | None = None) -> Column:
    """The text of piece ids: their bytes in a row, without the blank in front. Null stays null."""
    shared = spark.sparkContext.broadcast(Vocabulary.load(model_path).bytes_of())

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return decoded_slices(pa.array(shared.value, pa.binary()), batches)

    return decoded(ids)


def row_key(docs: DataFrame, id: str) -> Column:
    """A long from any id."""
    kind = dict(docs.dtypes)[id]
    column = F.col(f"`{id}`")
    return column.cast("long") if kind in ("bigint", "int", "smallint", "tinyint") \
        else F.xxhash64(column)


def with_pieces(
    docs: DataFrame, id: str = "doc_id", text: str = "text", name: str = "pieces",
    temper: float = 1.0, model_path: str | None = None,
) -> DataFrame:
    """``docs`` with sampled pieces in the column ``name``; repeated rows get equal pieces."""
    return docs.withColumn(name, encode(
        docs.sparkSession, row_key(docs, id), F.col(f"`{text}`").cast("string"), temper, model_path))
