import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsroster.llm import sampled_pieces as S, token_counts as T
from newsroster.llm.pieces import TokenNumbers, Vocabulary

TEXTS = ["", " ", "a", " a  b\n\n c\t😀 ▁x ", "x" * 5000, "\n", "a \n b", "漢字 é \x00", "the quick brown fox"]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


def segmentations(word, vocabulary):
    """All ways to cut a word into pieces, with weights."""
    if not word:
        yield (), 0.0
    for n in range(1, len(word) + 1):
        piece = word[:n]
        if piece in vocabulary.ids:
            step = (vocabulary.ids[piece],), vocabulary.log_p[piece]
        elif n == 1:
            raw = piece.encode()
            step = tuple(vocabulary.byte_ids[b] for b in raw), vocabulary.byte_log_p * len(raw)
        else:
            continue
        for rest, p in segmentations(word[n:], vocabulary):
            yield step[0] + rest, step[1] + p


def test_pre_tokens_give_the_text_back():
    for text in TEXTS:
        numbers = TokenNumbers()
        found, sizes = numbers([text])
        tokens = numbers.take_fresh()
        assert "".join(tokens[k] for k in found) == (" " + text if text else "")
        assert sizes.tolist() == [len(found)]


def test_sampled_shares(vocabulary):
    """Draws follow the product of piece probabilities."""
    word = "then"
    lattices = S.Lattices(vocabulary, 0.3)
    n = 20_000
    pieces, counts = S.encode_batch(lattices, list(range(n)), [word] * n)
    ends = np.cumsum(counts)
    got = Counter(tuple(pieces[e - c:e].tolist()) for e, c in zip(ends, counts))
    every = list(segmentations(" " + word, vocabulary))
    weight = {s: np.exp(0.3 * p) for s, p in every}
    whole = sum(weight.values())
    assert set(got) <= set(weight)
    for s, w in weight.items():
        share = w / whole
        assert abs(got[s] / n - share) < 5 * (share / n) ** 0.5 + 1e-3


def test_lossless_and_reproducible(spark, odd, docs):
    rows = odd.unionByName(docs(*[(100 + i, t) for i, t in enumerate(TEXTS)])).withColumn("no", F.lit(1))
    coded = S.with_pieces(rows)
    back = coded.select("doc_id", "text", "pieces", S.decode(spark, F.col("pieces")).alias("back")).collect()
    assert all(r.text == r.back for r in back) and len(back) == rows.count()
    again = S.with_pieces(rows.repartition(5)).select("doc_id", "text", "pieces").collect()
    assert Counter((r.doc_id, r.text, str(r.pieces)) for r in back) == Counter(
        (r.doc_id, r.text, str(r.pieces)) for r in again)
    assert S.with_pieces(rows.limit(0)).collect() == []


def test_long_words_keep_their_scale(vocabulary):
    lattices = S.Lattices(vocabulary, 1.0)
    text = "éx" * 4000
    pieces, _ = S.encode_batch(lattices, [1], [text])
    table = vocabulary.bytes_of()
    assert b"".join(table[i] for i in pieces)[1:].decode() == text


def test_counts_are_those_of_the_best_segmentation(vocabulary):
    words = ["then", "thing", "the", "theatre", "漢字", "a😀b", "xqzj"]
    trie = T.TrieCounts(vocabulary)
    for text in [" ".join(words), *words]:
        want = 0
        for word in text.split(" "):
            every = list(segmentations(" " + word, vocabulary))
            best = max(p for _, p in every)
            want += min(len(s) for s, p in every if p > best - 1e-9)
        assert trie([text]).tolist() == [want]


def test_counts_of_odd_rows(odd):
    got = {(r.doc_id, r.text): r.n_tokens for r in T.with_token_counts(odd).collect()}
    assert got[(2, "")] == got[(7, None)] == 0 and got[(6, "word " * 30_000)] >= 30_000
    assert T.with_token_counts(odd.limit(0)).collect() == []


def test_kept_pre_tokens_give_the_same_pieces(monkeypatch):
    """Renewing the lattice cache (and keeping the pre-tokens that came back) never changes a draw."""
    from newsroster.llm.pieces import Vocabulary
    from newsroster.llm.sampled_pieces import Lattices, encode_batch

    vocabulary = Vocabulary.load(None)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "x" * 80, "日本語", "the", "and"]
    slices = [[" ".join(words[(k * j) % len(words)] for j in range(40)) + "\n  two  blanks \n", None, ""]
              for k in range(1, 12)]
    keys = [[k, k + 1, k + 2] for k in range(len(slices))]
    plain = Lattices(vocabulary, 1.0)
    want = [encode_batch(plain, kk, [t or "" for t in texts]) for kk, texts in zip(keys, slices)]
    monkeypatch.setattr(S, "MOST_NODES", 60)
    renewals, renew = [], Lattices.renew
    monkeypatch.setattr(Lattices, "renew", lambda self: renewals.append(1) or renew(self))
    small = Lattices(vocabulary, 1.0)
    got = [encode_batch(small, kk, [t or "" for t in texts]) for kk, texts in zip(keys, slices)]
    for (a, n), (b, m) in zip(want, got):
        assert a.tolist() == b.tolist() and n.tolist() == m.tolist()
    assert len(renewals) >= 5 and (small.uses >= 2).any()  # renewed on the way, frequent ones kept


def test_lattices_of_many_tokens_are_those_of_each(vocabulary):
    """Built together they have the edges and shares that one token built alone has."""
    draw = random.Random(8)
    tokens = sorted({draw.choice(["", " "]) + "".join(draw.choice("abeinst😀漢é\0½ ") for _ in range(draw.randint(1, 12)))
                     for _ in range(400)} | {"e" * 64, "\n", " the", " them", " theme"})
    together, alone = S.Lattices(vocabulary, 0.7), S.Lattices(vocabulary, 0.7)

    def edges(lattices, node):
        while node:
            low = lattices.last[node - 1] + 1
            yield [(lattices.below[k], lattices.code[k]) for k in range(low, lattices.last[node] + 1)]
            node = lattices.origin[low]  # the shortest edge has one character

    assert together.add_short(["x"]).tolist() == [1]
    for token, node in zip(tokens, together.add_short(tokens)):
        assert list(edges(together, node)) == list(edges(alone, alone.add_long(token)))
    assert np.all(np.diff(together.last) > 0)


def test_pieces_are_handed_over_by_slice(vocabulary):
    """What a task holds and sends at a time does not grow with its batches."""
    texts = [("word%d " % k) * 60_000 for k in range(8)] + [None, "", "end"]
    keys = pa.array(list(range(10)) + [None], pa.int64())
    whole = S.encode_batch(S.Lattices(vocabulary, 1.0), list(range(10)) + [0], [t or "" for t in texts])[0]
    table, taken, coded, back = pa.array(vocabulary.bytes_of(), pa.binary()), [], [], []

    def batches():
        for at in (0, 6):
            taken.append(at)
            yield keys.slice(at, 6), pa.array(texts, pa.string()).slice(at, 6)

    for part in S.encoded_slices(S.Lattices(vocabulary, 1.0), batches()):
        coded.append(part)
        if len(coded) == 1:
            assert taken == [0]  # the second batch is not read ahead
        back += [x.to_pylist() for x in S.decoded_slices(table, iter([part]))]
    assert [len(part) for part in coded] == [1] * 7 + [4]  # 360,000 characters a text
    assert sum(back, []) == texts
    assert np.concatenate([x.flatten().to_numpy() for x in coded]).tolist() == whole.tolist()
    assert len(list(S.decoded_slices(table, iter([pa.concat_arrays(coded)])))) > 1


def test_batches_of_many_slices(spark, docs):
    """Rows keep their pieces where a batch holds many slices, with nulls and empty texts between."""
    rows = [(k, None if k % 7 == 3 else "" if k % 7 == 5 else ("w%d x " % k) * 20_000) for k in range(30)]
    coded = S.with_pieces(docs(*rows).coalesce(1)).select(
        "doc_id", S.decode(spark, F.col("pieces")).alias("back"), F.col("pieces").isNull().alias("none"))
    assert {r.doc_id: (r.back, r.none) for r in coded.collect()} == {k: (t, t is None) for k, t in rows}
