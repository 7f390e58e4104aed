import math
import random

import numpy as np
import pytest

from newsroster.llm import language as L

WORDS = {"aa": ["the", "and", "thing", "with"], "bb": ["der", "und", "nicht", "für"]}


def labelled(docs, n=80):
    draw = random.Random(1)
    return docs(*[(i, " ".join(draw.choices(WORDS[k], k=20)), k, "s")
                  for i in range(n) for k in [("aa", "bb")[i % 2]]])


@pytest.fixture(scope="module")
def model(docs):
    return L.train(labelled(docs))


def brute(model, raw, k):
    """Code length by walking back to the longest known context at each byte."""
    number = {c: i for i, c in enumerate(model.contexts, 1)}
    padded, total = L.PAD + raw, 0.0
    for i in range(L.ORDER, len(padded)):
        state = next((number[padded[i - n:i]] for n in (3, 2, 1) if padded[i - n:i] in number), 0)
        total += float(model.bits[state, model.classes[padded[i]], k])
    return total


def test_code_lengths(model):
    texts = [b"", "für the thing".encode(), bytes(range(256)), b"x", b"", b"the and " * 50]
    for most in (5, 40, 10 ** 6):
        got = L.Scorer(model)(texts, most)
        want = np.array([[brute(model, t, k) for k in range(2)] for t in texts])
        assert np.allclose(got, want, atol=1e-3)


def test_escapes_by_hand():
    """One language, text 'ab' + 'ab': after 'a' only 'b' was seen."""
    model = L.LanguageModel.from_counts({"x": {b"\n\n\na": 2, b"\n\nab": 2}}, 100)
    state = 1 + model.contexts.index(b"a")
    assert model.bits[state, model.classes[ord("b")], 0] == pytest.approx(-math.log2(2 / 3))
    root = -math.log2(2 / 6)  # a: 2 of 4, two kinds of bytes
    assert model.bits[0, model.classes[ord("a")], 0] == pytest.approx(root)
    assert model.bits[state, model.classes[ord("a")], 0] == pytest.approx(-math.log2(1 / 3) + root)
    assert model.bits[0, 0, 0] == pytest.approx(-math.log2(2 / 6) + 8)


def test_predictions(docs, model):
    rows = docs((1, "thing with the", "aa"), (2, "nicht für und", "bb"), (3, None), (4, ""), (5, "12 !?"),
                (None, "the", None), (1, "thing with the", "aa"), (6, "und nicht " * 50_000, "bb"),
                (7, "½ ² ①"), (8, "Ⅷ"))  # numbers, not letters
    got = L.with_language(rows, model).select("doc_id", "text", "language.*").collect()
    assert len(got) == 10
    for r in got:
        assert 0 <= r.score <= 1
        assert r.lang_pred == {1: "aa", 2: "bb", 6: "bb", None: "aa"}.get(r.doc_id, "und")
    assert L.with_language(rows.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    from newsroster.llm.catalog import op1_language_id

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(folder + "/documents.parquet").select("doc_id", "lang")
    rows = op1_language_id(spark, folder).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows) > 0


def test_nothing_learned(odd):
    model = L.train(odd.limit(0))
    assert {r.language.lang_pred for r in L.with_language(odd, model).collect()} == {"und"}
