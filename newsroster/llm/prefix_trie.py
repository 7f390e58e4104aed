"""Conversation prefix trie: shared openings of conversations, screened by a count-min sketch of prefix digests.

Every rebuilt conversation gives one row per prefix depth (the root included), keyed by a digest of its first ``d``
turns: two sums of positional 52-bit hashes, so that a prefix digest is a running sum along the conversation.

A count-min sketch of these digests (two rows of ``width`` counters) is built by one aggregation; it is reduced to
one bit per counter, "two or more", and packed into 64-bit words, ``2 * width / 64`` rows at most, which is what is
broadcast. A digest whose counter reads one in either row is proven to belong to one conversation only, and so are
all deeper prefixes of that conversation: those tails are emitted where they are, without a shuffle. Only possibly
shared prefixes are grouped by digest, exactly; the sketch only decides what needs grouping, never a result.

Subtree sums need no walk of the tree: a node's members are the conversations through it, and each node of the
subtree has one representative, its smallest member, which is so from its depth on. ``n_leaves`` counts members that
represent a childless full conversation; ``saved_tokens`` is the members' bytes below the node minus the bytes of the
nodes they represent.

Width: four counters per prefix row (estimated from the number of turns and conversations), at least 2^10 and at most
2^22; above that bound the screen lets more prefixes through to the exact grouping, results stay the same.

Defined results: rows with a null conv_id form no conversation; a null role or text is empty; turns are ordered by
turn (nulls first), then role and text, so repeated rows stay in; a conversation without turns, or rebuilt empty,
is a member of the root alone and ends there; an empty table gives no rows. Two different prefixes of equal depth
are taken for one only if both 52-bit sums agree, about 2^-104 per pair. The members that end at one node are
collected, as ids, in one task to be hashed in order; that list is the only per-node list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

MASK = (1 << 52) - 1


def _sorted_turns(rows: Column, conv: Column) -> Column:
    mine = F.filter(rows, lambda x: x["c"] == conv)
    return F.sort_array(F.transform(mine, lambda x: F.struct(
        x["turn"].alias("turn"), x["role"].alias("role"), x["text"].alias("text"))))


def rebuilt(turns: DataFrame, mod: int = 5, heads: int = 9) -> DataFrame:
    """One row per conversation: ``__b`` (its base), ``__c`` and ``__seq``, the rebuilt turns.

    Conversation c takes the first h = crc32(decimal c) % ``heads`` turns of conversation c - c % ``mod``, then its
    own turns after its first h. Conversations are grouped by base, at most ``mod`` of them in a group.
    """
    t = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    groups = t.groupBy((F.col("c") - F.col("c") % mod).alias("__b")).agg(
        F.collect_list(F.struct("c", "turn", "role", "text")).alias("__rows"))
    convs = groups.select("__b", "__rows", F.explode(F.array_distinct(F.transform(
        "__rows", lambda x: x["c"]))).alias("__c"))
    h = (F.crc32(F.col("__c").cast("string").cast("binary")) % heads).cast("int")
    own, base = _sorted_turns(F.col("__rows"), F.col("__c")), _sorted_turns(F.col("__rows"), F.col("__b"))
    tail = F.when(F.size(own) > h, F.slice(own, h + 1, F.size(own) - h)).otherwise(F.slice(own, 1, 0))
    return convs.select("__b", "__c", F.concat(F.slice(base, 1, h), tail).alias("__seq"))


def _prefix_rows(conv: DataFrame) -> DataFrame:
    """One row per (conversation, depth) with the prefix digest, its parent's, and byte sums."""
    rows = conv.select("__b", "__c", F.size("__seq").alias("L"), "__seq",
                       F.explode(F.sequence(F.lit(0), F.size("__seq"))).alias("d"))
    turn = F.element_at("__seq", F.greatest(F.col("d"), F.lit(1)))
    part = {}
    for name, salt in (("h1", "trie-a"), ("h2", "trie-b")):
        part[name] = F.when(F.col("d") > 0, (F.xxhash64(F.lit(salt), "d", turn["role"], turn["text"])
                                             .bitwiseAND(F.lit(MASK))).cast("decimal(38,0)")).otherwise(0)
    rows = rows.select("__b", "__c", "L", "d", part["h1"].alias("h1"), part["h2"].alias("h2"),
                       F.when(F.col("d") > 0, F.octet_length(turn["text"])).otherwise(0).cast("long")
                       .alias("bytes"))
    conv_w = Window.partitionBy("__b", "__c").orderBy("d")
    upto = conv_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = conv_w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return rows.select(
        "__b", "__c", "L", "d", "bytes",
        F.sum("h1").over(upto).alias("s1"), F.sum("h2").over(upto).alias("s2"),
        F.sum("bytes").over(after).alias("sb")
    ).withColumns({"p1": F.lag("s1").over(conv_w), "p2": F.lag("s2").over(conv_w)})


def _screened(pre: DataFrame, width: int) -> DataFrame:
    """Adds ``s``, the first depth proven singleton by the sketch (L + 1 if none), and ``sb_s``, the bytes from it."""
    spots = [F.pmod(F.xxhash64(F.lit(j), "d", "s1", "s2"), F.lit(width)) for j in (0, 1)]
    seen = pre.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), spots[j].alias("pos"))
                                          for j in (0, 1)])).alias("x")).select("x.*")
    full = seen.groupBy("j", "pos").count().where(F.col("count") >= 2).groupBy(
        "j", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(pos % 64 AS INT))")).alias("bits"))
    marked = pre.withColumns({"__p0": spots[0], "__p1": spots[1]})
    for j in (0, 1):
        words = F.broadcast(full.where(F.col("j") == j).select(
            F.col("word").alias(f"__w{j}"), F.col("bits").alias(f"__bits{j}")))
        marked = marked.join(words, F.shiftright(f"__p{j}", 6) == F.col(f"__w{j}"), "left")
    maybe = [F.expr(f"(shiftright(coalesce(__bits{j}, 0L), CAST(__p{j} % 64 AS INT)) & 1L) = 1L") for j in (0, 1)]
    conv_w = Window.partitionBy("__b", "__c")
    marked = marked.withColumn("s", F.coalesce(F.min(F.when(~(maybe[0] & maybe[1]), F.col("d"))).over(conv_w),
                                               F.col("L") + 1))
    return marked.withColumn("sb_s", F.coalesce(F.max(F.when(F.col("d") == F.col("s"), F.col("sb"))).over(conv_w),
                                                F.lit(0).cast("long"))) \
        .select("__c", "L", "d", "bytes", "s1", "s2", "p1", "p2", "sb", "s", "sb_s")


def _ends(ids: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.transform(F.array_sort(ids), lambda i: i.cast("string"))), 256)


def prefix_trie(turns: DataFrame, mod: int = 5, heads: int = 9, width: int | None = None) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 (all long but the hash). ``turns`` needs conv_id, turn, role and text; others are not read."""
    spark = turns.sparkSession
    if width is None:
        rows = turns.count()
        width = 1 << max(10, min(22, (8 * max(rows, 1) - 1).bit_length()))
    pre = stored(_screened(_prefix_rows(rebuilt(turns, mod, heads)), width), "trie-prefixes")
    key = ["d", "s1", "s2"]
    shared, local = pre.where("d < s"), pre.where("d >= s")

    nodes = shared.groupBy(*key).agg(
        F.min("__c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.first("p1").alias("p1"), F.first("p2").alias("p2"),
        _ends(F.collect_list(F.when(F.col("d") == F.col("L"), F.col("__c")))).alias("ends_sha256"))
    nodes = stored(nodes, "trie-nodes")
    boundary = local.where("d = s AND d > 0")
    child_of = nodes.where("d > 0").select((F.col("d") - 1).alias("d"), F.col("p1").alias("s1"),
                                           F.col("p2").alias("s2")).unionByName(
        boundary.select((F.col("d") - 1).alias("d"), F.col("p1").alias("s1"), F.col("p2").alias("s2")))
    children = child_of.groupBy(*key).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, key, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stored(nodes, "trie-counted")

    reps = shared.join(nodes.select(*key, F.col("conv_id").alias("__rep"), F.col("n_children").alias("__kids")),
                       key).withColumn("rep", F.col("__c") == F.col("__rep"))
    conv_w = Window.partitionBy("__c")
    reps = reps.withColumn("t", F.coalesce(F.min(F.when(F.col("rep"), F.col("d"))).over(conv_w), F.col("s")))
    reps = reps.withColumns({
        "sb_t": F.coalesce(F.max(F.when(F.col("rep") & (F.col("d") == F.col("t")), F.col("sb"))).over(conv_w),
                           F.col("sb_s")),
        "leaf": F.when(F.col("L") >= F.col("s"), F.lit(1)).otherwise(F.max(F.when(
            F.col("d") == F.col("L"), (F.col("rep") & (F.col("__kids") == 0)).cast("int"))).over(conv_w))})
    shares = reps.select(*key, F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"),
                         F.when(F.col("d") < F.col("t"), F.col("sb") - F.col("sb_t")).otherwise(0).cast("long")
                         .alias("saved"))
    sums = shares.groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    parents = nodes.select((F.col("d") + 1).alias("__d"), F.col("s1").alias("p1"), F.col("s2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.join(sums, key).join(parents, (F.col("d") == F.col("__d")) & (nodes["p1"] == parents["p1"])
                                       & (nodes["p2"] == parents["p2"]), "left")
    inner = inner.select("conv_id", F.col("d").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                         "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    edge = local.where("d = s").join(parents, (F.col("d") == F.col("__d")) & (local["p1"] == parents["p1"])
                                     & (local["p2"] == parents["p2"]), "left").drop("__d", "p1", "p2")
    tails = edge.unionByName(local.where("d > s").drop("p1", "p2").withColumn(
        "parent_conv_id", F.lit(None).cast("long")))
    tails = tails.select(
        F.col("__c").alias("conv_id"), F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") > F.col("s"), F.col("__c")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"), (F.col("d") < F.col("L")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.sha2(F.when(F.col("d") == F.col("L"), F.col("__c").cast("string")).otherwise(F.lit("")), 256)
        .alias("ends_sha256"))
    del spark
    return inner.unionByName(tails)
