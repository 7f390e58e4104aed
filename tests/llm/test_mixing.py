import re

import pytest

from newsroster.llm.mixing import mix, mixed_rows


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares, cut and reshared until no target is too high."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        whole = sum(w for s, w in weight.items() if s not in fixed)
        share = {s: rest * w / whole for s, w in weight.items() if s not in fixed}
        above = {s: most * sizes[s] for s in share if share[s] > most * sizes[s]}
        if not above:
            return {**fixed, **share}
        fixed.update(above)


def test_targets_and_bounds(docs):
    import random

    draw = random.Random(5)
    rows = [(i, "w " * draw.randint(0, 60), None, draw.choice(["a", "b", "c", "d", None] + ["e"] * 9))
            for i in range(600)] + [(9_000, "x", None, "tiny"), (9_001, None, None, "zero")]
    df = docs(*rows)
    got = mix(df).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    sizes = {}
    for i, text, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = targets(sizes)
    taken = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] = taken.get(s, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30.5
    assert {(r.doc_id, r.taken) for r in mix(df.repartition(7)).collect()} == {
        (r.doc_id, r.taken) for r in got}


def test_longer_documents_are_favoured(docs):
    rows = [(i, "w " * (100 if i % 2 else 4), None, "ab"[i > 2000]) for i in range(2100)]
    rows += [(5000, "w " * 200_000, None, "a")]
    got = [r for r in mix(docs(*rows, clash=False), weights=(1, 8)).collect() if r.doc_id <= 2000]
    long, short = [[r.copies for r in got if r.size == n] for n in (100, 4)]
    assert sum(long) / len(long) > sum(short) / len(short)


def test_odd_rows(odd):
    got = mix(odd).collect()
    assert len(got) == odd.count()
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mix(odd.limit(0)).collect() == []


def test_rows_are_repeated(odd):
    rows = mixed_rows(odd.where("doc_id > 1"))
    assert rows.columns == odd.columns
    copies = {r.doc_id: r.copies for r in mix(odd.where("doc_id > 1")).collect() if r.copies}
    assert {r[0]: r[1] for r in rows.groupBy("doc_id").count().collect()} == copies
