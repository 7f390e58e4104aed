import math

import numpy as np
import pytest

from newsroster.llm import codebooks

SCHEMA = "vec_id long, embedding array<float>, label int, `__code` string, kept string"


def brute(vectors, parts=2, entries=3, rounds=4):
    """Plain k-means per part position over all entries, no pruning."""
    x = np.array([[math.floor(4096 * float(np.float32(v))) for v in vec] for vec in vectors], dtype=np.int64)
    width = x.shape[1] // parts
    books = [x[:entries, p * width:(p + 1) * width].copy() for p in range(parts)]

    def assign():
        codes, err = [], np.zeros(len(x), dtype=np.int64)
        for p in range(parts):
            d = ((x[:, None, p * width:(p + 1) * width] - books[p][None]) ** 2).sum(axis=2)
            codes.append(d.argmin(axis=1))
            err += d.min(axis=1)
        return np.stack(codes, axis=1), err

    for _ in range(rounds):
        codes, _ = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                members = x[codes[:, p] == e, p * width:(p + 1) * width]
                if len(members):
                    books[p][e] = members.sum(axis=0) // len(members)
    codes, err = assign()
    return codes, err, [b.tolist() for b in books]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(6, 4)) * 0.3
    rows = [base[i % 6] + rng.normal(size=4) * 0.02 for i in range(60)]
    return [[float(np.float32(v)) for v in r] for r in rows]


def test_codes_equal_brute_force(spark, vectors):
    rows = [(i, v, i % 3 if i % 7 else None, "x", "y") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA)
    out, books = codebooks.quantize(df, parts=2, entries=3, rounds=4, pivots=2)
    got = {r["vec_id"]: (r["__code"], r["__error"]) for r in out.collect()}
    codes, err, want = brute(vectors)
    assert books == want
    for i in range(len(vectors)):
        assert got[i] == (list(codes[i]), err[i])
    digest = {r["vec_id"]: r for r in codebooks.digest(out, books).collect()}
    by_label = {}
    for i, (_, _, label, *_) in enumerate(rows):
        by_label[label] = by_label.get(label, 0) + err[i]
    for i, (_, _, label, *_) in enumerate(rows):
        assert digest[i]["label_error"] == by_label[label]
        assert digest[i]["code"] == "".join(f"{c:02x}" for c in codes[i])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25], 1, None, None), (1, [0.5, 0.25], 1, None, None), (2, None, 2, None, None),
            (3, [nan, 0.0], None, None, None), (4, [inf, 0.0], None, None, None), (5, [0.1, None], 1, None, None),
            (6, [0.1, 0.2, 0.3], None, None, None), (None, [-0.5, -0.25], None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out, books = codebooks.quantize(df, parts=2, entries=16, rounds=2)
    got = sorted((r["vec_id"] is None, r["vec_id"], r["__code"], r["__error"]) for r in out.collect())
    # two copies of id 1 and the null id are kept; their entries are the rows themselves
    assert got == [(False, 1, [0, 0], 0), (False, 1, [0, 0], 0), (True, None, [2, 2], 0)]
    assert books == [[[2048], [2048], [-2048]], [[1024], [1024], [-1024]]]
    empty, none = codebooks.quantize(df.limit(0), parts=2)
    assert empty.count() == 0 and none == []
    odd_length, none = codebooks.quantize(df.where("vec_id = 6"), parts=2)
    assert odd_length.count() == 0 and none == []


def test_pruning_is_exact():
    rng = np.random.default_rng(3)
    x = rng.integers(-500, 500, size=(400, 4))
    book = rng.integers(-500, 500, size=(16, 4))
    book[5] = book[9]  # a tie goes to the lower index
    piv = codebooks._pivots(book, 3)
    to_piv = np.sqrt(((x[:, None] - piv[None]) ** 2).sum(axis=2).astype(float))
    which, best, exact = codebooks._nearest(x, to_piv, book, piv)
    d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert (which == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact < 400 * 16
