import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsroster.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_differencing_balances_and_keeps_every_item():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 700, size=300)
    bins, m = packing.pack_sizes(sizes, 1024)
    members = np.sort(np.concatenate(bins))
    assert (members == np.arange(300)).all()
    sums = [int(sizes[b].sum()) for b in bins]
    assert max(sums) <= 1024 and len(bins) == m
    assert m <= 1.15 * np.ceil(sizes.sum() / 1024)  # items up to 700 of 1024 cannot fill every window
    # the classic case {4, 5, 6, 7, 8}: differencing leaves 16 against 14 (the best split is 15 and 15)
    halves = packing.differencing(np.array([4, 5, 6, 7, 8]), 2)
    assert sorted(int(np.array([4, 5, 6, 7, 8])[b].sum()) for b in halves) == [14, 16]
    assert packing.differencing(np.array([], dtype=np.int64), 3) == []


def test_pieces_round_trip_and_windows(spark, docs):
    long_text = "token " * 5000
    df = docs((1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "no id"),
              (4, long_text), (5, "<|endoftext|> stays text"))
    pieces = packing.token_pieces(df, PATH, window=64)
    out = packing.pack(pieces, window=64, group_pieces=3).collect()
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    texts = {1: "Hello world", 2: "", 3: "", None: "no id", 4: long_text, 5: "<|endoftext|> stays text"}
    by_doc = {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for key, text in texts.items():
        want = tok.encode(text, add_special_tokens=False).ids + [0]
        rows = sorted(by_doc[key], key=lambda r: r["start"])
        copies = 2 if key == 1 else 1
        assert len(rows) == copies * len(range(0, len(want), 64))
        got = [i for r in rows[::copies] for i in r["ids"]]
        assert got == want and all(r["doc_tokens"] == len(want) for r in rows)
    windows = {}
    for r in out:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 64
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))


def test_empty_table(spark, docs):
    empty = docs((1, "x")).limit(0)
    assert packing.pack(packing.token_pieces(empty, PATH)).count() == 0


def test_ranks_give_the_ids_of_the_tokenizer(spark, docs):
    texts = ["Hello world", "", "  lead and trail  ", "a\r\n\tb", "<|endoftext|> stays text", "ü漢字😀 é́",
             "token " * 3000, "x" * 20000, "1234567 numbers, 3.14!"]
    df = docs(*[(i, t) for i, t in enumerate(texts)])
    both = [packing.token_pieces(df, PATH, window=100, ranks=ranks).orderBy("doc_id", "start").collect()
            for ranks in (None, (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))]
    assert [tuple(r) for r in both[0]] == [tuple(r) for r in both[1]]
