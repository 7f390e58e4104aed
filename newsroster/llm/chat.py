"""Chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.binding import let

START, END, BETWEEN = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"
SPAN = "array<struct<start:int, end:int>>"


def escape(text: Column) -> Column:
    r"""Break up every ``<|``: one more backslash between the two. No control string remains."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(
    turns: DataFrame, trained: tuple[str, ...] = ("assistant",), conv: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One training text per conversation: ``conv_id, formatted, loss_spans``.

    A conversation's turns are collected, sorted (by turn, then role and text; null first) and
    written as ``<|im_start|>role`` newline text ``<|im_end|>`` newline. Neighbouring turns of
    one role are merged into one such block, their texts divided by ``<|im_sep|>``, so that they
    can be told apart again. ``<|`` inside texts and roles is escaped reversibly.
    ``loss_spans`` are the code point ranges of the texts whose role is in ``trained``.

    Null roles and texts are empty. Repeated rows are turns of their own. A null id is one
    conversation. Other columns are ignored; an empty table gives an empty result. The result of
    a conversation is one row, so its turns meet in one task, as the result itself does.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    sorted_ = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    every = F.col("turns")

    def piece(x, i):
        goes_on = (i > 0) & (F.get(every, i - 1)["role"] == x["role"])
        ends = ~F.coalesce(F.get(every, i + 1)["role"] == x["role"], F.lit(False))
        return F.struct(
            F.when(goes_on, BETWEEN).otherwise(
                F.concat(F.lit(START), _escape_role(x["role"]), F.lit("\n"))).alias("head"),
            escape(x["text"]).alias("body"),
            F.when(ends, END).otherwise("").alias("tail"),
            x["role"].isin(*trained).alias("loss"))

    laid = sorted_.select("conv_id", F.transform(every, piece).alias("pieces"))
    formatted = laid.select("conv_id", F.array_join(F.transform(
        "pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"))
    # Offsets by a running sum over the pieces of a conversation: linear in its turns. The rows are
    # already partitioned by conversation, so the window and the regrouping add no shuffle.
    placed = laid.select("conv_id", F.posexplode("pieces").alias("i", "p"))
    conversation = Window.partitionBy("conv_id").orderBy("i")
    size = F.length(F.col("p.head")) + F.length(F.col("p.body")) + F.length(F.col("p.tail"))
    before = F.coalesce(F.sum(size).over(conversation.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = placed.withColumn("__start", before + F.length(F.col("p.head"))).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("p.loss"), F.struct(
            F.col("__start").cast("int").alias("start"),
            (F.col("__start") + F.length(F.col("p.body"))).cast("int").alias("end"))))).alias("loss_spans"))
    return formatted.join(spans, formatted["conv_id"].eqNullSafe(spans["conv_id"])).select(
        formatted["conv_id"], "formatted", F.coalesce("loss_spans", F.array().cast(SPAN)).alias("loss_spans"))


def parse_chats(formatted: Column) -> Column:
    """The turns of a formatted text: an array of ``role, text``, as they were before merging."""
    def quoted(marker):
        return "\\Q" + marker + "\\E"

    blocks = F.filter(F.split(formatted, quoted(END), -1), lambda b: b != "")

    def of_block(block):
        rest = F.substring(block, len(START) + 1, F.length(block))
        head = F.substring_index(rest, "\n", 1)
        texts = F.split(F.substring(rest, F.length(head) + 2, F.length(rest)), quoted(BETWEEN), -1)
        return F.transform(texts, lambda t: F.struct(
            _unescape_role(head).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, of_block))


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under a mask. Four bytes per code point make each cut direct; the text
    is encoded once per row, not once per span."""
    return let(F.encode(formatted, "UTF-32"), lambda wide: F.transform(spans, lambda s: unescape(F.decode(
        F.substring(wide, s["start"] * 4 + 1, (s["end"] - s["start"]) * 4), "UTF-32"))))


def digest(chats: DataFrame) -> DataFrame:
    """What can be read back from formatted chats: turns and masked text as counts and digests."""
    parsed = chats.select(
        "conv_id", "formatted", parse_chats(F.col("formatted")).alias("turns"),
        F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    written = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
