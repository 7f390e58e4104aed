"""Near duplicates by an exact Jaccard join of word n-grams, with grouped prefixes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import sampled_ids, stored
from .components import components
from .workers import in_slices, worker_state

MOST_WORDS = 100_000  # distinct words whose hashes a worker remembers between slices
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
BLOOM_BITS = 1 << 20
BITS, WIDE_BITS = 1024, 4096  # of a set's bitmap, and of a second one that large sets have
LARGE = 512


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word n-grams as sorted 64-bit hashes.

    Words are the runs between ASCII blanks after lower-casing A-Z. With fewer words than ``width``
    the whole sequence is the one n-gram; without words the set is empty.
    """

    def __init__(self, width: int):
        self.width = width
        self.numbers: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.uint64)

    def _words(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.numbers) > MOST_WORDS:
            self.numbers.clear()
            self.hashes = self.hashes[:0]
        numbers, fresh, rows = self.numbers, [], []
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
            for word in set(words).difference(numbers):
                numbers[word] = len(numbers)
                fresh.append(xxhash.xxh3_64_intdigest(word))
            rows.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        self.hashes = np.concatenate([self.hashes, np.array(fresh, np.uint64)])
        return [self.hashes[row] for row in rows]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        sets = []
        for h in self._words(texts):
            n = len(h) - self.width + 1
            if n < 1 and len(h):
                n, width = 1, len(h)
            else:
                width = self.width
            if not len(h):
                sets.append(h)
                continue
            value = np.full(n, width, np.uint64)
            for k in range(width):  # a chain, so that the order of words counts
                value = _mixed(value * np.uint64(FACTORS[k % 4]) + h[k:k + n])
            sets.append(np.unique(value))
        return sets


def _shingler(width: int) -> Shingler:
    return worker_state(("shingles", width), lambda: Shingler(width))


def frequent_shingles(
    docs: DataFrame, id: str, text: str, width: int, sample: int, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of n-grams found three times or more in a sample of documents.

    They only decide the order in which prefixes are taken: rare n-grams first makes prefixes
    meet less often. Any order gives the same links, so the bounds (``sample`` documents, ``most``
    n-grams) touch no result.
    """
    @F.arrow_udf("array<bigint>")
    def shingled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts, in in_slices(batches, pc.utf8_length):
            sets = [s.view(np.int64) for s in _shingler(width)(texts.to_pylist())]
            yield pa.array(sets, pa.list_(pa.int64()))

    ids = F.broadcast(sampled_ids(docs, id, sample, "shingles"))
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    found = (
        rows.join(ids, "id", "left_semi").select(F.explode(shingled("t")).alias("s"))
        .groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
        .orderBy(F.desc("n"), "s").limit(most).toArrow())
    hashes = found.column("s").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order]


def prefix_length(n: int, percent: int) -> int:
    """Two sets of which the one has n n-grams can only reach ``percent`` if among that many of
    its n-grams, first in a common order, there is one of the other's."""
    return n + (-percent * n // 100) + 1


def sketches(docs: DataFrame, id: str, text: str, width: int, percent: int,
             sample: int, most_frequent: int) -> DataFrame:
    """``doc_id, n, set_id, g, bits, wide, tokens``: set size, a 128-bit hash of the set, a hash of
    its prefix and size, a bitmap that holds at each place whether an odd number of n-grams falls
    there, a wider one for sets of 512 or more (else empty), and the prefix, rare n-grams first."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        frequent_shingles(docs, id, text, width, sample, most_frequent))
    kind = pa.struct([("n", pa.int32()), ("set_id", pa.binary()), ("g", pa.int64()),
                      ("bits", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64())),
                      ("tokens", pa.list_(pa.int64()))])

    def bitmap(s: np.ndarray, size: int) -> np.ndarray:
        places = (s & np.uint64(size - 1)).astype(np.int64)
        return np.packbits(np.bincount(places, minlength=size).astype(np.uint8) & 1).view(np.int64)

    @F.arrow_udf("struct<n:int,set_id:binary,g:bigint,bits:array<bigint>,wide:array<bigint>,"
                 "tokens:array<bigint>>")
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, counts = shared.value
        for texts, in in_slices(batches, pc.utf8_length):
            sizes, set_ids, groups, bits, wide, tokens = [], [], [], [], [], []
            for s in _shingler(width)(texts.to_pylist()):
                n, prefix = len(s), s
                if n:
                    rank = np.zeros(n, np.int64)
                    if len(hashes):
                        at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                        rank = np.where(hashes[at] == s, counts[at], 0)
                    prefix = s[np.argsort(rank, kind="stable")][:prefix_length(n, percent)]
                sizes.append(n)
                set_ids.append(xxhash.xxh3_128_digest(s.tobytes()))
                groups.append(xxhash.xxh3_64_intdigest(prefix.tobytes(), n))
                bits.append(bitmap(s, BITS))
                wide.append(bitmap(s, WIDE_BITS) if n >= LARGE else s[:0].view(np.int64))
                tokens.append(prefix.view(np.int64))
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int32()), pa.array(set_ids, pa.binary()),
                 pa.array(np.array(groups, np.uint64).view(np.int64)),
                 *[pa.array(x, pa.list_(pa.int64())) for x in (bits, wide, tokens)]],
                fields=list(kind))

    return docs.select(
        F.col(f"`{id}`").alias("doc_id"),
        sketched.asNondeterministic()(F.col(f"`{text}`").cast("string")).alias("x")).select(
        "doc_id", "x.*")


def _among(rows: DataFrame, name: str, ids: DataFrame) -> DataFrame:
    """Those ``rows`` whose column ``name`` is among ``ids`` (column ``id``), and few others: a
    Bloom filter of fixed size (at most 16,384 words), broadcast as a table. It thins out rows
    before a join decides."""
    def place(column: str) -> Column:
        return F.xxhash64(column).bitwiseAND(F.lit(BLOOM_BITS - 1).cast("long"))

    def word(p: Column) -> Column:
        return F.shiftright(p, 6).cast("int")

    def bit(p: Column) -> Column:
        return p.bitwiseAND(F.lit(63).cast("long")).cast("int")

    p = F.col("p")
    words = stored(ids.select(place("id").alias("p")).groupBy(word(p).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(p))).alias("bits")),
        "jaccard-bloom")
    return rows.withColumn("p", place(name)).withColumn("w", word(p)).join(
        F.broadcast(words), "w").where(F.getbit("bits", bit(p)) == 1).select(*rows.columns)


def verified(pairs: DataFrame, docs: DataFrame, id: str, text: str, width: int,
             percent: int) -> DataFrame:
    """Those ``pairs`` of sets (``a, a_doc, b, b_doc``) that link, by their whole texts.

    Texts rather than sets travel, as they compress, and only those of documents in pairs.
    """
    @F.arrow_udf("boolean")
    def links(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for part in in_slices(batches, lambda a, a_text, b, b_text: pc.add(
                pc.utf8_length(a_text), pc.utf8_length(b_text))):
            a, a_text, b, b_text = [column.to_pylist() for column in part]
            left, right = _shingler(width)(a_text), _shingler(width)(b_text)
            found = []
            for a_id, x, b_id, y in zip(a, left, b, right):
                same = len(np.intersect1d(x, y, assume_unique=True))
                # Rows that repeat an id may have another text than the one meant.
                found.append(100 * same >= percent * (len(x) + len(y) - same)
                             and xxhash.xxh3_128_digest(x.tobytes()) == a_id
                             and xxhash.xxh3_128_digest(y.tobytes()) == b_id)
            yield pa.array(found, pa.bool_())

    wanted = pairs.select(F.col("a_doc").alias("id")).union(pairs.select("b_doc"))
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    texts = _among(rows.where("t IS NOT NULL"), "id", wanted)
    joined = (
        pairs.join(texts.select(F.col("id").alias("a_doc"), F.col("t").alias("a_text")), "a_doc")
        .join(texts.select(F.col("id").alias("b_doc"), F.col("t").alias("b_text")), "b_doc"))
    return stored(joined.where(links("a", "a_text", "b", "b_text")).select("a", "b").distinct(),
                  "jaccard-links")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair once, the smaller set first."""
    ends = F.array_sort(F.array(F.struct(F.col("a").alias("set"), F.col("a_doc").alias("doc")),
                                F.struct(F.col("b").alias("set"), F.col("b_doc").alias("doc"))))
    return pairs.where("a <> b").select(ends.alias("e")).select(
        F.col("e")[0]["set"].alias("a"), F.col("e")[0]["doc"].alias("a_doc"),
        F.col("e")[1]["set"].alias("b"), F.col("e")[1]["doc"].alias("b_doc")).distinct()


def _may_link(percent: int, n: Column, pos: Column, m: Column, q: Column) -> Column:
    """Whether sets of n and m n-grams can link if the first one they share stands at ``pos`` and
    ``q`` of their prefixes."""
    return (100 + percent) * F.least(n - pos, m - q) >= percent * (n + m)


def _bits_allow(percent: int, n: Column, bits: Column, m: Column, others: Column) -> Column:
    """Whether two bitmaps leave it possible that the sets link: at least as many n-grams are in
    only one of the sets as there are places where the bitmaps differ."""
    apart = sum(F.bit_count(F.get(bits, F.lit(k)).bitwiseXOR(F.get(others, F.lit(k))))
                for k in range(BITS // 64))
    return (100 + percent) * (n + m - apart) >= 2 * percent * (n + m)


def _thinned(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of large sets that their wide bitmaps allow too, and all other pairs."""
    def side(name: str, n: str, wide: str) -> DataFrame:
        return sets.select(F.col("set_id").alias(name), F.col("n").alias(n), F.col("wide").alias(wide))

    apart = F.aggregate(
        F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, k: s + k)
    n = F.col("n") + F.col("m")
    allowed = (100 + percent) * (n - apart) >= 2 * percent * n
    both = (F.size("x") > 0) & (F.size("y") > 0)
    return pairs.join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b").where(
        ~both | allowed).select("a", "a_doc", "b", "b_doc")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
    sample: int = 8_000, most_frequent: int = 100_000,
) -> DataFrame:
    """Connected components of near-equal documents.

    A document's set are its distinct n-grams of ``width`` words. Two documents link when
    100 * intersection >= ``percent`` * union. Returns ``doc_id, n_shingles, component_id`` for
    every row, ``component_id`` the smallest id that links lead to. Texts that are null or have
    no word have an empty set and link with nothing. Rows that repeat an id are documents of
    their own with that id; rows with a null id get a null component and link nothing. Other
    columns are ignored; an empty table gives an empty result.

    The join: documents with one and the same set count as one. Of each set the prefix is taken,
    and sets with equal prefix and size form a group that is looked up once per n-gram. Groups
    that share an n-gram of their prefixes may link if sizes and places allow (``_may_link``).

    First round: per n-gram, every group is paired only with the group where the n-gram stands
    foremost, and within a group every set with one of it; pairs expand to sets. Second round:
    what shares an n-gram but lies in different components so far is paired; n-grams of a single
    group count too, by the first of its prefix, if several of its sets may link. Before a pair is
    emitted it must pass the bounds by size, place and bitmap, which no linking pair fails; the
    whole texts decide. Any two linked documents share an n-gram of their prefixes, so each link
    is found, or both ends are connected already: the components are exact. Copies of one text,
    and sets that hang together, are never expanded into all pairs.
    """
    found = stored(sketches(docs, id, text, width, percent, sample, most_frequent), "jaccard-sketches")
    usable = found.where("n > 0 AND doc_id IS NOT NULL")
    sets = stored(usable.groupBy("set_id").agg(
        F.min("doc_id").alias("doc"), F.min("g").alias("g"), F.min("n").alias("n"),
        F.first("bits").alias("bits"), F.first("wide").alias("wide"),
        F.min(F.get("tokens", F.lit(0))).alias("head")), "jaccard-sets")
    rows = usable.select("g", "n", F.posexplode("tokens").alias("pos", "token")).select(
        "token", "g", (F.col("pos").cast("long") * (1 << 32) + F.col("n")).alias("place"))
    # Different sets of one size n can link if all but one of their n-grams may be shared.
    crowded = sets.where(100 * (F.col("n") - 1) >= percent * (F.col("n") + 1)).groupBy("g").agg(
        F.count(F.lit(1)).alias("k"), F.min("head").alias("token")).where("k > 1")
    common = stored(
        rows.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high"))
        .where("low < high").select("token").union(crowded.select("token")).distinct(),
        "jaccard-tokens")
    hits = stored(rows.join(common, "token").distinct(), "jaccard-hits").select(
        "token", "g", "place", (F.col("place") % (1 << 32)).cast("int").alias("n"),
        F.floor(F.col("place") / (1 << 32)).cast("int").alias("pos"))
    foremost = stored(hits.groupBy("token").agg(
        F.min_by("g", "place").alias("first"), F.min("place").alias("p")), "jaccard-foremost").select(
        "token", "first", (F.col("p") % (1 << 32)).cast("int").alias("first_n"),
        F.floor(F.col("p") / (1 << 32)).cast("int").alias("first_pos"))
    stars = (
        hits.join(foremost, "token").where(F.col("g") != F.col("first"))
        .where(_may_link(percent, F.col("n"), F.col("pos"), F.col("first_n"), F.col("first_pos")))
        .select("g", "first").distinct())
    members = sets.select("g", F.col("set_id").alias("b"), F.col("doc").alias("b_doc"), "n", "bits")
    leaders = sets.groupBy("g").agg(F.min("set_id").alias("set_id")).select("set_id").join(
        sets, "set_id").select(
        F.col("g").alias("first"), F.col("set_id").alias("a"), F.col("doc").alias("a_doc"),
        F.col("n").alias("m"), F.col("bits").alias("others"))
    groups = stars.unionByName(sets.select("g", F.col("g").alias("first")).distinct())
    names = ["a", "a_doc", "b", "b_doc"]
    allowed = _bits_allow(percent, F.col("n"), F.col("bits"), F.col("m"), F.col("others"))
    tried = stored(_thinned(_ordered(
        groups.join(leaders, "first").join(members, "g").where((F.col("a") != F.col("b")) & allowed)
        .select(names)), sets, percent), "jaccard-tried")
    links = verified(tried, docs, id, text, width, percent)

    known = components(links)
    placed = (
        hits.join(members.drop("n", "bits"), "g")
        .join(known.withColumnRenamed("node", "b"), "b", "left")
        .withColumn("label", F.coalesce("label", "b")))
    spread = placed.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least"))
    # The largest partner that a set can link with, given where the n-gram stands.
    reach = F.floor((100 + percent) * (F.col("n") - F.col("pos")) / percent) - F.col("n")
    live = stored(
        placed.join(spread.where("low < high"), "token").where(reach >= F.col("least"))
        .select("token", "b", "b_doc", "n", "pos", "label")
        .join(members.select("b", "bits"), "b")
        # The n-gram before this one, of those that count here.
        .withColumn("prev", F.lag("token").over(Window.partitionBy("b").orderBy("pos"))),
        "jaccard-live")
    one = live.select("token", F.col("b").alias("a"), F.col("b_doc").alias("a_doc"), F.col("n").alias("m"),
                      F.col("pos").alias("q"), F.col("label").alias("of"), F.col("bits").alias("others"),
                      F.col("prev").alias("before"))
    # Sets that share a run of n-grams are paired at its first one only.
    first = F.coalesce(F.col("prev") != F.col("before"), F.lit(True))
    more = _ordered(one.join(live, "token").where(
        (F.col("a") < F.col("b")) & (F.col("of") != F.col("label")) & first
        & _may_link(percent, F.col("n"), F.col("pos"), F.col("m"), F.col("q")) & allowed).select(names))
    more = stored(_thinned(more.join(tried, ["a", "b"], "left_anti"), sets, percent), "jaccard-more")
    links = links.union(verified(more, docs, id, text, width, percent))

    labels = components(links)
    labelled = found.select("doc_id", "n", "set_id").join(
        labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "label", F.when(F.col("n") > 0, F.coalesce("label", "set_id")))
    smallest = stored(
        labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least")),
        "jaccard-components")
    return labelled.join(smallest, "label", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, with all their columns.

    Rows without words or without an id stay. Rows that repeat an id go together: all of them if
    one hangs together with a smaller id.
    """
    found = near_duplicates(docs, id, text, width, percent)
    dropped = stored(
        found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(),
        "jaccard-dropped")
    return docs.join(dropped, F.col(f"`{id}`") == F.col("__gone"), "left_anti")
