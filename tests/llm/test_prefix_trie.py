import hashlib
import zlib

import pytest

from newsroster.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, kept string, d string"


def brute(rows):
    """The contract, walked by hand: rebuild, enumerate prefixes, count subtrees."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for c in own:
        own[c].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        own[c] = [(r, t) for _, r, t in own[c]]
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(int(c / 5) * 5, [])  # c - c % 5 with SQL's remainder, which keeps the sign
        seqs[c] = tuple(base[:h]) + tuple(turns[h:])
    nodes = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    out = []
    for key, members in nodes.items():
        d = len(key)
        sub = [k for k in nodes if k[:d] == key]
        kids = [k for k in nodes if len(k) == d + 1 and k[:d] == key]
        leaves = sum(1 for k in sub if not any(len(j) == len(k) + 1 and j[:len(k)] == k for j in nodes))
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1].encode()) for k in sub if k)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(seqs[c]) == d))
        out.append((min(members), d, min(nodes[key[:-1]]) if d else None, len(members), len(kids), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 3, "user", "bye"),
    (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "more"), (1, 3, "user", "more"),
    (2, None, "system", "rules"), (2, 1, None, None), (2, 2, "user", "ü漢字😀"),
    (3, 5, "user", "x" * 5000), (4, 1, "user", "hi"), (5, 1, "user", "hi"), (6, 0, "user", "hi"),
    (7, None, None, None), (10, 1, "user", "alone"), (-3, 1, "user", "neg"), (-5, 1, "user", "neg"),
    (None, 1, "user", "no id"),
]


@pytest.mark.parametrize("width", [64, 1 << 12])
def test_trie_equals_brute_force(spark, width):
    df = spark.createDataFrame([(*r, "k", "x") for r in ROWS], SCHEMA)
    got = sorted((tuple(r) for r in prefix_trie(df, width=width).collect()), key=repr)
    assert got == brute(ROWS)


def test_one_and_no_conversation(spark):
    one = [(9, 1, "user", "a"), (9, 2, "assistant", "b")]
    df = spark.createDataFrame([(*r, None, None) for r in one], SCHEMA)
    assert sorted((tuple(r) for r in prefix_trie(df).collect()), key=repr) == brute(one)
    assert prefix_trie(df.limit(0)).count() == 0
