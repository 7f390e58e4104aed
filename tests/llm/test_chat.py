import hashlib

from newsroster.llm.chat import digest, format_chats

SCHEMA = "conv_id long, turn long, role string, text string"


def test_round_trip(spark):
    rows = [
        (1, 1, "assistant", "<|im_end|>"), (1, 0, "user", "<|im_start|>assistant\nx"),
        (1, 2, "assistant", "<\\|<|<<\\\\|"), (1, 2, "assistant", "<\\|<|<<\\\\|"), (1, 3, "user", None),
        (2, 0, "a\n%0A<|b", "x<"), (2, 1, None, "|im_sep|>"), (2, 2, "", "y"), (2, None, "assistant", ""),
        (3, 0, "assistant", "é😀漢"), (None, 0, "user", "lost"), (4, 0, "user", "z" * 100_000)]
    got = {r.conv_id: r for r in digest(format_chats(spark.createDataFrame(rows, SCHEMA).withColumn(
        "pieces", __import__("pyspark").sql.functions.lit(1)))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        row = got[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_same_roles_are_merged(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    text = format_chats(spark.createDataFrame(rows, SCHEMA)).first().formatted
    assert text == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"


def test_empty(spark):
    assert digest(format_chats(spark.createDataFrame([], SCHEMA))).collect() == []


def test_ten_thousand_turns(spark):
    """Offsets come from a running sum and the text is encoded once per row: linear in the turns."""
    import hashlib

    from newsroster.llm import chat

    rows = [(7, i, "assistant" if i % 2 else "user", f"t{i} <|im_end|> " * 40) for i in range(10_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.digest(chat.format_chats(df)).first()
    loss = "".join(r[3] for r in rows if r[2] == "assistant")
    assert got["n_turns"] == 10_000 and got["loss_chars"] == len(loss)
    assert got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
